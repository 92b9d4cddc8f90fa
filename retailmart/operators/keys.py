"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailmart.sources.scratch import written

_PARTITION_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def number_rows(df: DataFrame, order: Sequence[str], key: str) -> DataFrame:
    """Add ``key`` = 1..n in ascending ``order`` (NULL first), which must be unique.

    A range-partitioned sort puts the rows in order over all tasks. Each row is
    written together with its place, partition and row number, so the rows are
    computed once and a lost executor cannot shift them. The key is then the place
    plus the number of rows in earlier partitions, a table of one row per written
    partition: small whatever the data holds.
    """
    ordered = df.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    placed = written(ordered.withColumn("_place", F.monotonically_increasing_id()), key)
    partition = F.shiftright("_place", _PARTITION_BITS)
    row = F.col("_place").bitwiseAND((1 << _PARTITION_BITS) - 1)

    sizes = placed.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_partition", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_earlier"))

    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .select((F.col("_earlier") + row + 1).alias(key), *df.columns)
    )
