"""N:1 lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str],
    how: str = "inner",
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Bring columns ``take`` of ``dimension`` to ``rows``, joined as ``{rows column: dimension column}``.

    Columns in ``null_safe`` match NULL with NULL; the join stays an equi-join.
    No hint is given: the planner broadcasts a dimension only if its size allows.
    """
    right = dimension.select(*[F.col(c).alias(f"_{c}") for c in on.values()], *take)
    matches = [
        F.col(left).eqNullSafe(F.col(f"_{name}")) if left in null_safe else F.col(left) == F.col(f"_{name}")
        for left, name in on.items()
    ]
    return rows.join(right, matches, how).drop(*[f"_{c}" for c in on.values()])


def lowest_key(dimension: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """One row per ``by`` with the lowest ``key``: makes a fan-out join N:1 before it runs."""
    return dimension.groupBy(*by).agg(F.min(key).alias(key))
