"""The next row in key order, without sorting a table in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def followed(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Add ``next_<column>`` of the following row by ``key``; the first row follows the last.

    Rows of equal key are ordered by ``columns``, NULL first. The keys are cut into
    blocks at actual keys, found from the key column alone; a row goes to its block, and the
    first row of a block also, as a guest, behind the block before. Only the block
    bounds, some per shuffle partition, pass through the driver.
    """
    spark = df.sparkSession
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(F.col(key).alias("k")).where("k is not null").repartitionByRange(blocks, "k")
    firsts = sorted(r.k for r in keys.groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("k")).select("k").collect())
    names = [f"next_{c}" for c in columns]
    plain = df.drop(*names)
    if not firsts:
        firsts = [0]
    step = math.isqrt(len(firsts)) + 1
    bounds, coarse = F.array(*[F.lit(k) for k in firsts]), F.array(*[F.lit(k) for k in firsts[::step]])
    far = F.greatest(F.size(F.filter(coarse, lambda b: b <= F.col(key))) - 1, F.lit(0)) * step
    near = F.size(F.filter(F.slice(bounds, far + 1, F.lit(step)), lambda b: b <= F.col(key))) - 1
    block = F.when(F.col(key).isNull(), 0).otherwise(F.greatest(far + near, F.lit(0)))
    out = plain.withColumn("__block", block)
    leads = (F.get(bounds, F.col("__block")) == F.col(key)) | F.col(key).isNull()
    before = F.when(F.col("__block") == 0, len(firsts) - 1).otherwise(F.col("__block") - 1)
    own = F.struct(F.lit(0).alias("__guest"), F.col("__block").alias("__block"))
    guest = F.struct(F.lit(1).alias("__guest"), before.alias("__block"))
    placed = F.explode(F.when(leads, F.array(own, guest)).otherwise(F.array(own)))
    out = out.select(*plain.columns, placed.alias("__at")).select(*plain.columns, "__at.__guest", "__at.__block")
    order = Window.partitionBy("__block").orderBy("__guest", F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in columns if c != key])
    out = out.select(*plain.columns, "__guest", *[F.lead(c).over(order).alias(n) for c, n in zip(columns, names, strict=True)])
    return out.where("__guest = 0").drop("__guest")
