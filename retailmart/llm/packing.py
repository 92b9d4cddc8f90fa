"""Packing documents into sequences of fixed capacity by linear grouping.

1. Texts become pieces of tokens inside the task that reads them. From here on only lengths move.
2. Pieces are ranked by falling length with a range sort over all tasks. The number of pieces of each length, at most
   one row per length up to the capacity, is all that the driver needs to plan; whatever the table holds, the plan is of
   that order too.
3. Large pieces are cut by rank into groups of equal cardinality and rounded up to the group's largest. For these few
   sizes a linear program over configurations (what fits into one sequence) is solved by column generation; configurations are
   used as often as its solution says, rounded down. The plan gives each group's ranks to configurations in ranges,
   so every piece finds its sequence from its rank.
4. The room that is left is counted again with the actual lengths. The rest, large pieces that no configuration took and
   small ones, goes to the fullest sequence with room enough, longest first. Sequences of equal room and pieces of equal length
   are alike, so this best fit is planned for whole ranges of ranks with the outcome of a one-by-one run: a
   sequence that takes pieces keeps less than half its room, so a range is cut a few times at most.

A length that a third of all pieces share is one entry of the plan; its pieces are many ranks, which the
range sort deals out evenly.

Defined results: NULL text is empty and has the end token only; repeated rows and rows without id are documents of their
own; a length outside 1 to the capacity fails the job; an empty table gives an empty result. Columns ``sequence_id`` and
``offset`` of the input are replaced.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailmart.llm.text import filled
from retailmart.operators.keys import number_rows
from retailmart.sources.scratch import written

CAPACITY = 2048
GROUPS = 256  # of large lengths
LARGE_PARTS = 3  # a piece of more than a third of the capacity is large
GAP = 1e-3  # the linear program ends when no configuration could lower its cost by more than this share
# fixed values: how the byte-level vocabulary splits text, and its end of a text
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = "<|endoftext|>"
END = 0  # closes every document
_LONG_BLANK = re.compile(r"\s{50000}")


# --- tokens ------------------------------------------------------------------


@lru_cache(maxsize=1)
def _encoders(ranks: bytes, definition: bytes):
    """A fast encoder by ranks, and the defining one for the few texts that the first cannot take."""
    import tiktoken
    from tokenizers import Tokenizer

    merges = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=merges, special_tokens={}), Tokenizer.from_buffer(definition)


def _cut(batches: Iterator[pa.RecordBatch], ranks: bytes, definition: bytes, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    fast, exact = _encoders(ranks, definition)
    for batch in batches:
        schema = batch.schema
        for number, text in enumerate(batch.column(batch.num_columns - 1)):
            text = text.as_py()
            odd = SPECIAL in text or (len(text) >= 50_000 and _LONG_BLANK.search(text))
            ids = array("I", exact.encode(text, add_special_tokens=False).ids if odd else fast.encode_ordinary(text))
            ids.append(END)
            whole = np.frombuffer(ids, np.uint32).astype("<u4", copy=False)
            head = len(whole) % capacity if len(whole) > capacity else len(whole)
            starts = [0] * (head > 0) + list(range(head, len(whole), capacity))
            parts = [whole[a:b] for a, b in zip(starts, [*starts[1:], len(whole)], strict=True)]
            columns = [pa.repeat(batch.column(i)[number], len(parts)) for i in range(batch.num_columns - 1)]
            columns += [
                pa.array(range(len(parts)), pa.int32()), pa.array(starts, pa.int64()), pa.array([len(p) for p in parts], pa.int64()),
                pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
            ]
            names = [*schema.names[:-1], "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([p.tolist() for p in parts], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def token_pieces(df: DataFrame, ranks: bytes, definition: bytes, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``(key, piece, start, length, ids_crc32)`` per piece, with ``ids`` on request: only longer documents are cut, the first piece may be shorter."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    cut = partial(_gathered, of=partial(_cut, ranks=ranks, definition=definition, capacity=capacity, with_ids=with_ids))
    return df.select(key, filled(text).alias("text")).mapInArrow(cut, schema)


def _gathered(batches: Iterator[pa.RecordBatch], of) -> Iterator[pa.RecordBatch]:
    """The small batches of ``of`` in larger ones."""
    held, rows = [], 0
    for batch in of(batches):
        held.append(batch)
        rows += batch.num_rows
        if rows >= 2000:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if held:
        yield pa.concat_batches(held)


# --- planning, on counts alone --------------------------------------------------


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of sizes that fit into the capacity, and how often a cheapest fractional solution uses each.

    Column generation: the basis starts with one size per configuration; a knapsack over the dual prices finds the
    configuration that helps most, until none does.
    """
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    use = np.linalg.solve(basis, demand)
    behind = np.arange(capacity + 1)[None, :] - sizes[:, None]  # room before a size was added
    for _ in range(30 * k):
        price = np.linalg.solve(basis.T, np.ones(k))
        # worth[n]: the dearest n sizes or fewer for each room, by adding one size to the dearest n - 1
        worth, added = [np.zeros(capacity + 1)], []
        for _ in range(capacity // int(sizes.min())):
            value = np.where(behind >= 0, worth[-1][np.maximum(behind, 0)] + price[:, None], -1.0)
            best = value.argmax(axis=0)
            better = value[best, np.arange(capacity + 1)] > worth[-1]
            added.append(np.where(better, best, -1))
            worth.append(np.where(better, value[best, np.arange(capacity + 1)], worth[-1]))
        if worth[-1][capacity] <= 1 + GAP:
            break
        column, room = np.zeros(k), capacity
        for layer in reversed(added):
            if layer[room] >= 0:
                column[layer[room]] += 1
                room -= sizes[layer[room]]
        along = np.linalg.solve(basis, column)
        ratio = np.where(along > 1e-9, use / np.where(along > 1e-9, along, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
        use = np.maximum(np.linalg.solve(basis, demand), 0)
    return basis.astype(int), use


def _lengths_of(counts: np.ndarray, start: int, stop: int) -> list[tuple[int, int, int]]:
    """``(length, from, to)`` of the ranks from start to stop; ranks fall from the longest."""
    ends = np.cumsum(counts[::-1])
    out, at = [], start
    while at < stop:
        place = int(np.searchsorted(ends, at, side="right"))
        to = min(stop, int(ends[place]))
        out.append((len(counts) - 1 - place, at, to))
        at = to
    return out


def plan_large(counts: np.ndarray, capacity: int, groups: int) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]], int]:
    """Ranges ``(from, to, per, base)`` of ranks that configurations take, ranges left over, number of sequences.

    A rank in a range goes to sequence ``base + (rank - from) // per``.
    """
    full, large = int(counts[capacity]), int(counts[capacity // LARGE_PARTS + 1 :].sum())
    ranges = [(0, full, 1, 0)] if full else []
    left, sequences = [], full
    each = max(1, -(-(large - full) // groups))
    merged: list[list[int]] = []  # size, from, to
    for start in range(full, large, each):
        size, stop = _lengths_of(counts, start, start + 1)[0][0], min(large, start + each)
        if merged and merged[-1][0] == size:
            merged[-1][2] = stop
        else:
            merged.append([size, start, stop])
    if merged:
        sizes, demand = np.array([m[0] for m in merged]), np.array([m[2] - m[1] for m in merged], float)
        columns, use = configurations(sizes, demand, capacity)
        at = [m[1] for m in merged]
        for j in range(columns.shape[1]):
            times = int(use[j] + 1e-6)
            for i in np.flatnonzero(columns[:, j]):
                per = int(columns[i, j])
                taken = min(times * per, merged[i][2] - at[i])
                if taken > 0:
                    ranges.append((at[i], at[i] + taken, per, sequences))
                    at[i] += taken
            sequences += times
        left = [(a, m[2]) for a, m in zip(at, merged, strict=True) if a < m[2]]
    total = int(counts.sum())
    return ranges, [*left, *([(large, total)] if large < total else [])], sequences


def plan_rest(counts: np.ndarray, left: list[tuple[int, int]], rooms: np.ndarray, capacity: int) -> list[tuple[int, int, int, int]]:
    """Best fit of the ranks in ``left``, longest first, into sequences that are ranked by rising room; ``rooms`` counts them by room.

    Ranges ``(from, to, per, base)`` as above; sequences from ``rooms.sum()`` on are new.
    """
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    start = 0
    for room, n in enumerate(rooms.tolist()):
        if n:
            free[room].append((start, start + n))
        start += n
    ranges = []
    for length, at, to in sorted((x for a, b in left for x in _lengths_of(counts, a, b)), key=lambda x: (-x[0], x[1])):
        room = length
        while at < to:
            while room <= capacity and not free[room]:
                room += 1
            if room > capacity:
                fresh = -(-(to - at) // (capacity // length))
                free[capacity].append((start, start + fresh))
                start, room = start + fresh, capacity
            first, last = free[room].pop()
            per = min(room // length, to - at)
            used = min(last - first, (to - at) // per)
            if first + used < last:
                free[room].append((first + used, last))
            ranges.append((at, at + used * per, per, first))
            after = room - per * length
            free[after].append((first, first + used))
            at += used * per
            room = min(room, max(after, length))
    return ranges


# --- packing -------------------------------------------------------------------


def _by_rank(batches: Iterator[pa.RecordBatch], ranges: list[tuple[int, int, int, int]]) -> Iterator[pa.RecordBatch]:
    """Fill the last column, the sequence of each rank; NULL where no range holds it."""
    table = np.array(sorted(ranges), np.int64).reshape(-1, 4)
    for batch in batches:
        rank = batch.column(batch.schema.get_field_index("__rank")).to_numpy(zero_copy_only=False) - 1
        found = np.searchsorted(table[:, 0], rank, side="right") - 1
        if len(table):
            start, stop, per, base = (table[np.maximum(found, 0), i] for i in range(4))
            none = (found < 0) | (rank >= stop)
            sequence = pa.array(base + (rank - start) // np.maximum(per, 1), pa.int64(), mask=none)
        else:
            sequence = pa.nulls(len(rank), pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sequence], schema=batch.schema)


def _counted(df: DataFrame, column: str, capacity: int) -> np.ndarray:
    """Rows by the value of a column that lies between 0 and the capacity."""
    counts = np.zeros(capacity + 1, np.int64)
    for value, n in df.groupBy(column).count().collect():
        counts[value] = n
    return counts


def pack(df: DataFrame, length: str = "length", capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """All rows with ``sequence_id`` and ``offset``: every sequence holds at most ``capacity``, gapless from 0."""
    columns = [c for c in df.columns if c not in ("sequence_id", "offset")]
    size = F.col(length).cast("bigint")
    valid = F.when(size.between(1, capacity), size).otherwise(F.raise_error(F.lit(f"a length outside 1 to {capacity}")).cast("bigint"))
    rows = df.select(*columns, valid.alias("__size"), F.monotonically_increasing_id().alias("__row"))
    rows = written(rows.withColumn("__down", -F.col("__size")), "pieces")  # row numbers stay as they are
    ranked = number_rows(rows, ("__down", "__row"), "__rank").drop("__down", "__row").withColumn("__bin", F.lit(None).cast("bigint"))
    counts = _counted(rows, "__size", capacity)
    ranges, left, sequences = plan_large(counts, capacity, groups)
    large = written(ranked.mapInArrow(partial(_by_rank, ranges=ranges), ranked.schema), "large")
    used = large.where("__bin is not null").groupBy(F.col("__bin").alias("__of")).agg((capacity - F.sum("__size")).alias("__room"))
    used = written(number_rows(used, ("__room", "__of"), "__sequence"), "rooms")
    rooms = _counted(used, "__room", capacity)
    ranges = plan_rest(counts, left, rooms, capacity)
    rest = large.where("__bin is null").mapInArrow(partial(_by_rank, ranges=ranges), large.schema)
    first = large.where("__bin is not null").join(used, F.col("__bin") == F.col("__of"))
    placed = first.select(*columns, "__size", "__rank", (F.col("__sequence") - 1).alias("sequence_id"))
    placed = placed.unionByName(rest.select(*columns, "__size", "__rank", F.col("__bin").alias("sequence_id")))
    before = Window.partitionBy("sequence_id").orderBy("__rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*columns, "sequence_id", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("offset"))
