"""Counts of rows that break a declared rule; one scan per table, no rows collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _labelled(df: DataFrame, values: Mapping[str, Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One row per label from a one-row aggregate, by exploding an array of structs."""
    rows = [
        F.struct(F.lit(label).alias("column_name"), *[v.alias(n) for v, n in zip(row, names)])
        for label, row in values.items()
    ]
    return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, checked, nulls``."""
    values = {c: (F.count("*"), F.count_if(F.col(c).isNull())) for c in columns}
    return _labelled(df, values, ("checked", "nulls"))


def too_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """``column_name, max_length, too_long``: text beyond its declared length."""
    values = {
        c: (F.coalesce(F.max(F.length(c)), F.lit(0)), F.count_if(F.length(c) > limit)) for c, limit in limits.items()
    }
    return _labelled(df, values, ("max_length", "too_long"))


def too_large(df: DataFrame, limits: Mapping[str, Decimal]) -> DataFrame:
    """``column_name, checked, too_large``: filled amounts, and those not below their limit."""
    values = {c: (F.count(c), F.count_if(F.abs(c) >= F.lit(limit))) for c, limit in limits.items()}
    return _labelled(df, values, ("checked", "too_large"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of keys, and of keys held by more than one row."""
    return df.groupBy(*keys).count().agg(
        F.count("*").alias("distinct_keys"), F.count_if(F.col("count") > 1).alias("repeated_keys")
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """One row: filled references, and those whose parent is missing.

    References are counted per value first, so a hot value shuffles as one row per task.
    """
    references = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).agg(F.count("*").alias("_rows"))
    # A repeated parent must not count a reference twice.
    found = parent.select(F.col(key).alias("_ref")).distinct().withColumn("_found", F.lit(True))
    return references.join(found, "_ref", "left").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("_rows"))), F.lit(0)).alias("orphans"),
    )
