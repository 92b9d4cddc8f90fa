"""Near-duplicates by SuperMinHash: signatures, bands, exact confirmation, union-find grouping.

The steps, each a Spark job over written tables:

1. Every text becomes its set of word shingles and its signature, inside the task that reads it. Equal
   sets are one node from here on, so copies are never expanded.
2. Signatures are cut into bands; nodes that share a band's key form a bucket.
3. In each bucket all members are held against one centre, the member that shares most buckets,
   weighted by their size: the text that others were copied from. Pairs that the signature
   leaves possible are confirmed on full sets. This is linear in the bucket.
4. Links are grouped. Members of a bucket that are still in another group than the bucket's centre are
   held against all its members, a block of the ones and a block of the others in one task, on full
   sets; only links leave the task. No pair is left out for the size of its bucket.
5. All links are grouped; a group's id is its smallest document id.

With 32 bands of 6, a pair of likeness 0.8 meets with a probability of 0.9999. Pairs whose 192 signature bits put
their likeness four standard deviations below the threshold are not confirmed.

Defined results: a NULL, empty or blank text has an empty set and is linked with nothing; a text of
fewer words than a shingle is one shingle; repeated rows, also under one id, are copies; a row without
id takes part in its group but gives it no id; an empty table gives an empty result. Sets and shingles are known by
64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailmart.llm.graph import components
from retailmart.llm.sketches import WordHashes, band_keys, one_bit, set_key, shingle_set, super_min_hash
from retailmart.sources.scratch import written

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 32, 6
SLOTS = BANDS * ROWS
BLOCK = 256  # members of a bucket in one block of step 4
_COLUMNS = 4096
_ELEMENTS = 50_000  # shingles signed at once; ranks take 384 bytes of each


def _signed(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()

    def emit(own: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        full = [s for s in sets if len(s)]
        signatures = super_min_hash(full, SLOTS) if full else np.empty((0, SLOTS), np.uint32)
        bands, bits = iter(band_keys(signatures, BANDS, ROWS).tolist()), iter(one_bit(signatures).tolist())
        return pa.RecordBatch.from_arrays(
            [
                *(own.column(i) for i in (0, 2, 3)),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                pa.array([next(bits) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ],
            ["id", "first", "second", "n_shingles", "node", "bands", "bits"],
        )

    for batch in batches:
        start, sets, held = 0, [], 0
        for at, text in enumerate(batch.column(1), 1):
            sets.append(shingle_set(text.as_py(), shingle, cache))
            held += len(sets[-1])
            if held >= _ELEMENTS or at == batch.num_rows:
                yield emit(batch.slice(start, at - start), sets)
                start, sets, held = at, [], 0


def _whole(text: str) -> list[Column]:
    """Two hashes that stand for a whole text."""
    return [F.xxhash64(text).alias("first"), F.xxhash64(F.lit("other"), F.col(text)).alias("second")]


def signatures(df: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """``(id, first, second, n_shingles, node, bands, bits, row)`` per row, written; ``node`` is NULL for an empty set."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).select("id", "text", *_whole("text"))
    schema = f"id {kind}, first bigint, second bigint, n_shingles bigint, node bigint, bands array<bigint>, bits array<bigint>"
    return written(rows.mapInArrow(partial(_signed, shingle=shingle), schema).withColumn("row", F.monotonically_increasing_id()), "signatures")


def _confirmed(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    cache, last, last_set = WordHashes(), None, None
    for batch in batches:
        a, b = [], []
        for x, y, text_x, text_y in zip(*(batch.column(i) for i in range(4)), strict=True):
            x, y = x.as_py(), y.as_py()
            if y != last:
                last, last_set = y, shingle_set(text_y.as_py(), shingle, cache)
            own = shingle_set(text_x.as_py(), shingle, cache)
            both = len(np.intersect1d(own, last_set, assume_unique=True))
            if 100 * both >= percent * (len(own) + len(last_set) - both):
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _possible(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs that their signature bits leave possible."""
    one, other = bits.select(F.col("node").alias("a"), F.col("bits").alias("one")), bits.select(F.col("node").alias("b"), F.col("bits").alias("other"))
    return pairs.join(one, "a").join(other, "b").where(_agree("one", "other") >= _least(percent)).select("a", "b")


def _agree(one: str, other: str):
    """Number of equal signature bits."""
    return SLOTS - sum(F.bit_count(F.get(one, F.lit(i)).bitwiseXOR(F.get(other, F.lit(i)))) for i in range(SLOTS // 64))


def _least(percent: int) -> int:
    """Equal bits of a pair at the threshold, less four standard deviations."""
    share = (1 + percent / 100) / 2
    return math.floor(SLOTS * share - 4 * math.sqrt(SLOTS * share * (1 - share)))


def _texts(df: DataFrame, nodes: DataFrame, needed: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """``(node, text)`` of the needed nodes, written: one row of each, picked by its id."""
    wanted = written(nodes.join(needed, "node").select("node", F.col("id").alias("__id")), "wanted")
    # dealt out by id at every size, as the needed nodes grow with the data
    rows = df.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("text")).join(wanted.hint("merge"), F.col("__key").eqNullSafe(F.col("__id")))
    return written(rows.select("node", "text").mapInArrow(partial(_own, shingle=shingle), "node bigint, text string").dropDuplicates(["node"]), "texts")


def _confirm(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets are alike enough, written."""
    first = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    rows = first.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")
    return written(rows.mapInArrow(partial(_confirmed, shingle=shingle, percent=percent), "a bigint, b bigint"), "links")


def _compared(table: pa.Table, shingle: int, percent: int) -> pa.Table:
    """Links between a block of members apart from the centre and a block of all members of their bucket.

    Intersections of all sets are products of presence matrices, some columns at a time. One link
    for a member and each other group it meets is enough.
    """
    cache = WordHashes()
    asks = np.array(table.column("asks").to_pylist(), bool)
    nodes, labels = (np.array(table.column(c).to_pylist(), np.int64) for c in ("node", "label"))
    sets = [shingle_set(t.as_py(), shingle, cache) for t in table.column("text")]
    one, other = np.flatnonzero(asks), np.flatnonzero(~asks)
    links: list[tuple[int, int]] = []
    if len(one) and len(other):
        vocabulary = np.unique(np.concatenate([sets[i] for i in other]))
        found = [np.searchsorted(vocabulary, np.intersect1d(s, vocabulary, assume_unique=True)) for s in sets]
        both = np.zeros((len(one), len(other)), np.float32)
        for start in range(0, len(vocabulary), _COLUMNS):
            present = np.zeros((len(sets), _COLUMNS), np.float32)
            for i, at in enumerate(found):
                low, high = np.searchsorted(at, (start, start + _COLUMNS))
                present[i, at[low:high] - start] = 1
            both += present[one] @ present[other].T
        sizes = np.array([len(s) for s in sets], np.float64)
        alike = 100 * both >= percent * (sizes[one][:, None] + sizes[other][None, :] - both)
        for i, j in zip(*np.nonzero(alike & (labels[one][:, None] != labels[other][None, :])), strict=True):
            links.append((int(one[i]), int(other[j])))
    seen, a, b = set(), [], []
    for x, y in links:
        if (x, labels[y]) not in seen:
            seen.add((x, labels[y]))
            a.append(int(nodes[x]))
            b.append(int(nodes[y]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _own(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the set it is asked for; others share only the id."""
    cache = WordHashes()
    for batch in batches:
        fits = [set_key(shingle_set(t.as_py(), shingle, cache)) == n.as_py() for n, t in zip(batch.column(0), batch.column(1), strict=True)]
        yield batch.filter(pa.array(fits, pa.bool_()))


def _groups(df: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """The signatures' rows with their group: ``component``, its smallest id, and ``lead``, the row of that id that comes first.

    A group without any id has a lead, too.
    """
    rows = signatures(df, key, text, shingle)
    lead = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "first", "second")).alias("lead")
    nodes = rows.where("node is not null").groupBy("node").agg(lead, F.first("bands").alias("bands"), F.first("bits").alias("bits"))
    nodes = written(nodes.select("node", "lead", F.col("lead.id").alias("id"), "bands", "bits"), "nodes")
    bits = nodes.select("node", "bits")

    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = written(entries.join(sizes, "bucket"), "members")
    degrees = members.groupBy("node").agg(F.sum("size").alias("degree"))
    centres = members.join(degrees, "node").groupBy("bucket").agg(F.max(F.struct("degree", "node"))["node"].alias("centre"))
    members = written(members.join(centres, "bucket"), "members")

    star = members.where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    tried = written(_possible(star, bits, percent), "tried")
    texts = _texts(df, nodes, members.select("node").distinct(), key, text, shingle)
    links = _confirm(tried, texts, shingle, percent)
    labels = components(links)

    # A bucket of two has no pair left.
    grouped = members.where("size > 2").join(labels, "node", "left").select("bucket", "node", "size", "centre", F.coalesce("label", "node").alias("label"))
    of_centre = labels.select(F.col("node").alias("centre"), F.col("label").alias("main"))
    grouped = written(grouped.join(of_centre, "centre", "left").select("bucket", "node", "size", "label", F.coalesce("main", "centre").alias("main")), "grouped")
    apart = grouped.where("label <> main")
    held = grouped.join(apart.groupBy("bucket").agg(F.count("*").alias("apart")), "bucket")

    def blocks(size: str) -> Column:
        return F.ceil(F.col(size) / BLOCK).cast("int")

    def place(size: str) -> Column:
        return F.pmod(F.xxhash64("node"), blocks(size).cast("bigint")).cast("int")

    def all_of(size: str) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks(size) - 1))

    asking = held.where("label <> main").withColumn("row", place("apart")).withColumn("column", all_of("size"))
    asked = held.withColumn("row", all_of("apart")).withColumn("column", place("size"))
    sides = asking.withColumn("asks", F.lit(True)).unionByName(asked.withColumn("asks", F.lit(False)))
    blocked = sides.select("bucket", "row", "column", "asks", "node", "label").join(texts, "node")

    def compare(table: pa.Table) -> pa.Table:
        return _compared(table, shingle, percent)

    more = written(blocked.groupBy("bucket", "row", "column").applyInArrow(compare, "a bigint, b bigint"), "links")
    if not more.isEmpty():
        links = links.union(more)
        labels = components(links)

    named = nodes.select("node", "lead").join(labels, "node", "left").select("node", "lead", F.coalesce("label", "node").alias("label"))
    lowest = named.groupBy("label").agg(F.min("lead").alias("lead"))
    found = named.select("node", "label").join(lowest, "label").select("node", "lead")
    return rows.select("id", "first", "second", "n_shingles", "node", "row").join(found, "node", "left")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(<key>, n_shingles, component_id, kept)`` per row; ``kept`` marks the smallest id of each group, or one row of a group without ids."""
    rows = _groups(df, key, text, shingle, percent)
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("lead.id"))
    kept = F.when(F.col("node").isNull(), True).when(F.col("lead.none"), F.col("row") == F.col("lead.row")).otherwise(F.col("id") == F.col("lead.id"))
    return rows.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(kept, F.lit(False)).alias("kept"))


def without_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group, the first of its smallest id, and all rows with an empty set; judged by row, not by id.

    The rows come back by id and text; of rows equal in both, the first by the other columns stays.
    """
    rows = _groups(df, key, text, shingle, percent)
    known = rows.groupBy(F.col("id").alias("__id"), F.col("first").alias("__a"), F.col("second").alias("__b")).agg(
        F.max(F.col("node").isNull()).alias("__alone"), F.max(F.coalesce(F.col("row") == F.col("lead.row"), F.lit(False))).alias("__leads"), F.count("*").alias("__rows")
    )
    known = written(known.where("__alone or __leads").select("__id", "__a", "__b", (F.col("__alone") | (F.col("__rows") == 1)).alias("__all")), "leads")
    marked = df.select("*", *[c.alias(f"__{n}") for c, n in zip(_whole(text), ("first", "second"), strict=True)])
    same = F.col(key).eqNullSafe(F.col("__id")) & (F.col("__first") == F.col("__a")) & (F.col("__second") == F.col("__b"))
    # only texts that stand in several rows of one id are sorted
    others = [F.col(c).asc_nulls_first() for c in df.columns if c not in (key, text)]
    among = Window.partitionBy("__id", "__a", "__b").orderBy(*others) if others else Window.partitionBy("__id", "__a", "__b").orderBy("__a")
    repeated = marked.join(known.where("not __all"), same).withColumn("__place", F.row_number().over(among)).where("__place = 1")
    return marked.join(known.where("__all"), same).select(*df.columns).unionByName(repeated.select(*df.columns))
