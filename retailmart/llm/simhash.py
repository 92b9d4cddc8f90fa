"""SimHash fingerprints and the search for fingerprints within a Hamming radius.

The terms of a text are its shingles of five lower-cased words, each occurrence
weighing one; a text of fewer words is one term. Every term's 64-bit hash votes on 64 signed
bits. Two votes are counted in one long, 32 bits each, so a document's votes are 32 sums that
Spark adds up map-side and in generated code.

The search keeps one table per choice of blocks that must agree. Fingerprints that
differ in at most ``radius`` bits agree in ``blocks - radius`` of the blocks, so each such pair
meets in some table; the first one reports it.

Defined results: NULL text counts as empty; an empty text has the constant fingerprint of
the empty term; rows equal in all keys count as one document; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmart.llm.text import words

SHINGLE = 5
BITS = 64
PAIR = 0x0000000100000001  # the lowest bit of both halves


def fingerprints(df: DataFrame, keys: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keys`` and ``fingerprint`` (bigint), one row per distinct value of the keys."""
    split = df.select(*keys, words(F.lower(F.coalesce(F.col(text), F.lit("")))).alias("__words"))
    placed = split.select(*keys, "__words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("__words") - shingle, F.lit(0)))).alias("__at"))
    term = F.xxhash64(*[F.get("__words", F.col("__at") + i) for i in range(shingle)])
    votes = placed.select(*keys, term.alias("__term"))
    half = BITS // 2
    sums = [F.sum(F.shiftrightunsigned("__term", i).bitwiseAND(F.lit(PAIR))).alias(f"__s{i}") for i in range(half)]
    counted = votes.groupBy(*keys).agg(F.count("*").alias("__n"), *sums)

    def bit(count: Column, place: int) -> Column:
        return F.shiftleft((2 * count > F.col("__n")).cast("bigint"), place)

    low = [bit(F.col(f"__s{i}").bitwiseAND(F.lit(0xFFFFFFFF)), i) for i in range(half)]
    high = [bit(F.shiftrightunsigned(f"__s{i}", half), i + half) for i in range(half)]
    return counted.select(*keys, reduce(Column.bitwiseOR, low + high).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def block_masks(radius: int, blocks: int) -> list[int]:
    """One mask, as a signed long, per choice of ``blocks - radius`` of the blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    spans = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    masks = [sum(choice) for choice in combinations(spans, blocks - radius)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def within(queries: DataFrame, among: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``(query, found)``: distinct fingerprints of both sides at most ``radius`` bits apart.

    Equal fingerprints are found too. Both inputs have a bigint column ``fingerprint``;
    fingerprints are made distinct first, so copies do not fill a table.
    """
    masks = block_masks(radius, blocks)

    def tables(df: DataFrame, name: str) -> DataFrame:
        distinct = df.where("fingerprint is not null").select(F.col("fingerprint").alias(name)).distinct()
        entries = F.array(*[F.struct(F.lit(i).alias("table"), F.col(name).bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)])
        return distinct.select(name, F.explode(entries).alias("e")).select(name, "e.table", "e.part")

    q, a = tables(queries, "query").alias("q"), tables(among, "found").alias("a")
    apart = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    meet = (F.col("q.table") == F.col("a.table")) & (F.col("q.part") == F.col("a.part"))
    return q.join(a, meet & (F.bit_count(apart) <= radius) & (first == F.col("q.table"))).select("query", "found")
