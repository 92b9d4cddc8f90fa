"""Top-k and row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, measure: str, k: int, ties: Sequence[str], descending: bool = True) -> DataFrame:
    """First ``k`` rows by ``measure``; ``ties`` must make the order total.

    Plans as a per-task heap and a merge of k rows per task, never a full sort.
    """
    best = F.col(measure).desc_nulls_last() if descending else F.col(measure).asc_nulls_last()
    return df.orderBy(best, *[F.col(c).asc_nulls_first() for c in ties]).limit(k)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, records``: one row per table."""
    counts = [t.agg(F.count("*").alias("records")).select(F.lit(n).alias("table_name"), "records") for n, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)
