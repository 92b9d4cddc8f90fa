"""Mixing sources to target weights by systematic sampling.

Targets fill up like water: every source gets its weight's share of all words, but
at most ``most`` times its own size, and what is cut off is shared out again by weight.
A document's expected copies are target over size of its source. Documents are put
in order within their source, their expected copies summed up from a random
offset of the source, and one copy goes out at each whole number that is crossed. The order goes
up by size through one half of the documents and down through the other, so neighbours
are alike, it ends where it began, and the offset cancels out of the words taken.

Prefix sums never gather a source in one task: rows are range-sorted over all tasks and
written, each written partition sums its own rows, and a partition starts at the
sum of the source's earlier ones, a table of one row per partition and source.

Defined results: NULL text has size 0; a source without words has target 0 and is not taken;
NULL is a source of its own, last in order; rows equal in id, source and text are one unit that is
taken or left together; an empty table gives an empty result. Sums are decimals, so reruns
and other partitionings agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailmart.llm.text import filled, words
from retailmart.operators.keys import number_rows
from retailmart.sources.scratch import written

WEIGHTS = (5, 2, 1)  # by rank of the source, repeating
MOST = 3  # times its size that a source is taken at most
UNIT = "decimal(20,12)"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Each round caps the sources whose share is above their limit and raises the level
    of the others; the driver sees two sums a round. Sums are of whole numbers, hence exact.
    """
    ordered = number_rows(sizes.withColumn("__null", F.col("source").isNull()), ("__null", "source"), "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = written(ordered.select("source", "source_size", weight.cast("bigint").alias("weight")), "sources")
    total, open_weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (total or 0) / (open_weight or 1)
    while True:
        capped = most * F.col("source_size") <= F.lit(level) * F.col("weight")
        cut, still = ranked.agg(F.sum(F.when(capped, most * F.col("source_size"))), F.sum(F.when(~capped, F.col("weight")))).first()
        risen = (total - (cut or 0)) / still if still else level
        if risen <= level:
            break
        level = risen
    target = F.least((most * F.col("source_size")).cast("double"), F.lit(float(level)) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def systematic(df: DataFrame, group: str, order: list[str], expected: str, seed: str) -> DataFrame:
    """Add ``copies`` to every row: whole numbers crossed by the group's running sum of ``expected``."""
    first = [F.col(group).isNull(), F.col(group), *[F.col(c) for c in order]]
    placed = written(df.withColumn("__units", F.col(expected).cast(UNIT)).orderBy(*first).withColumn("__place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("__part", F.shiftright("__place", 33)).withColumn("__group", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")))
    within = Window.partitionBy("__part", "__group").orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per partition and one more per group that starts in it
    starts = placed.groupBy("__group", "__part").agg(F.sum("__units").alias("__sum"))
    starts = starts.select("__group", "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("__group"))), 1, 8), 16, 10).cast("double") / 4294967296.0
    summed = placed.withColumn("__within", F.sum("__units").over(within)).join(starts, ["__group", "__part"])
    upto = F.col("__within") + F.col("__before") + draw.cast(UNIT)
    copies = F.floor(upto) - F.floor(upto - F.col("__units"))
    return summed.select(*df.columns, copies.cast("bigint").alias("copies"))


def mix(
    df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "mix"
) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target`` and ``copies``; columns of these names are replaced."""
    added = ("size", "source_size", "target", "copies")
    columns = [c for c in df.columns if c not in added]
    sized = df.select(*columns, F.size(words(filled(text))).cast("bigint").alias("size"), F.xxhash64(F.col(text)).alias("__hash"))
    units = sized.groupBy(F.col(key).alias("id"), F.col(source).alias("source"), F.col("__hash").alias("hash")).agg(F.max("size").alias("size"), F.count("*").alias("rows"))
    units = written(units, "units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    goals = targets(sizes, weights, most).select(F.col("source").alias("of"), "source_size", "target")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    placed = units.join(goals, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("share", share)
    # up by size through one half of the documents, down through the other: see above
    half = F.coalesce(F.ascii(F.md5(F.col("id").cast("string").cast("binary"))) % 2, F.lit(0))
    placed = placed.withColumn("half", half).withColumn("along", F.when(half == 0, F.col("size")).otherwise(-F.col("size")))
    taken = systematic(placed, "source", ["half", "along", "id", "hash"], "share", seed)
    taken = taken.select(F.col("id").alias("__id"), F.col("source").alias("__source"), F.col("hash").alias("__other"), "source_size", "target", "copies")
    same = F.col(key).eqNullSafe(F.col("__id")) & F.col(source).eqNullSafe(F.col("__source")) & (F.col("__hash") == F.col("__other"))
    return sized.join(taken, same).select(*columns, *added)
