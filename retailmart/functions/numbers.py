"""Money and averages in decimals, no floating point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums over a whole 100 TB history pass 10^16, the reach of decimal(18,2).
MONEY_SUM = "decimal(28,2)"


def ratio(numerator: Column, denominator: Column, scale: int, precision: int) -> Column:
    """Decimal quotient, carried to 12 digits and rounded half up; NULL over zero."""
    quotient = numerator.cast("decimal(26,2)") / F.nullif(denominator.cast("decimal(18,2)"), F.lit(0))
    return F.round(quotient, scale).cast(f"decimal({precision},{scale})")


def mean_money(total: Column, count: Column) -> Column:
    """Average amount in the six digits Spark's own ``avg(decimal(10,2))`` keeps."""
    return ratio(total, count, 6, 14)


def mart_mean(total: Column, count: Column) -> Column:
    """Average amount at the two digits the stored marts declare."""
    return ratio(total, count, 2, 18)
