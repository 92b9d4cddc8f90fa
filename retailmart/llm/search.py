"""Ranked lexical search: the best documents of every query by exact inner products, found with sparse ball trees.

1. Queries are taken in blocks of a bounded number of terms. A block's terms, some megabytes, travel with the functions.
2. One pass over the documents counts their terms and leaves, per document, its length and the frequencies of the block's terms.
   Other terms add nothing to a score of this block, so the index need not hold them.
3. Every task indexes its documents in trees. A node knows the centroid of its documents and the radius around it, and a
   document's score is its vector's inner product with the query's. It is at most the centroid's product plus the radius
   times the norm of the query, of which only the terms that the node's documents hold count. Coordinates are
   scaled by the weights of their terms first, which keeps products and makes balls of rare terms small.
4. A query opens the nodes of a tree from the largest bound on and stops below its tenth best score so far, which it takes
   along from tree to tree. Bounds are rounded up by more than their arithmetic can err, so nothing is lost; leaves are scored in whole numbers.
5. The best of every task are ranked per query.

All numbers are whole: weights are ``floor(1000 ln((2 N + 2) / (2 df + 1)))``, see ``term_values`` for the rest.

Defined results: NULL or empty text has no terms; a document without terms is none, a query without terms finds nothing; rows that repeat
an id are documents and queries of their own; of equal scores the smaller id is first, NULL last; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailmart.sources.scratch import written

BEST = 10
BLOCK_TERMS = 200_000  # terms of the queries that are searched at once
LEAF = 32  # documents in a leaf
NODE_CELLS = 1 << 22  # nodes times terms of a tree
TREE_ENTRIES = 1 << 22  # frequencies in a tree
QUERY_CELLS = 1 << 22  # queries times terms of a product

# fixed values: terms consist of digits, letters and all that is not ASCII; only A to Z change case
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(_TERM_BYTES).split() if text else []


def term_values(frequency: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The part of a score that depends on the document, for each of its frequencies; ``length`` is repeated likewise."""
    measure = 25 + (75 * length * documents) // total
    return (1_000_000_000 * frequency) // (1000 * frequency + 8 * measure)


# --- vectors -------------------------------------------------------------------


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counted = [Counter(terms(t)) for t in batch.column(2).to_pylist()]
        names = pa.array([list(c) for c in counted], pa.list_(pa.binary()))
        times = pa.array([list(c.values()) for c in counted], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), names, times], ["query", "id", "terms", "times"])


def _vectors(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    known = vocabulary.__contains__
    for batch in batches:
        texts = batch.column(1).to_pylist()
        lengths, places, frequencies = [], [], []
        for text in texts:
            own = terms(text)
            counted = Counter(filter(known, own))
            lengths.append(len(own))
            places.append([vocabulary[t] for t in counted])
            frequencies.append(list(counted.values()))
        columns = [batch.column(0), pa.array(lengths, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(frequencies, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "times"])


# --- trees ---------------------------------------------------------------------


class Rows:
    """Sparse rows: the entries of row i are those from ``start[i]`` to ``start[i + 1]``."""

    def __init__(self, start: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.start, self.term, self.value = start, term, value

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.start[rows + 1] - self.start[rows]
        start = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.repeat(self.start[rows] - start[:-1], sizes) + np.arange(start[-1])
        return Rows(start, self.term[flat], self.value[flat])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Products with a dense vector; no row is empty."""
        return np.add.reduceat(self.value * dense[self.term], self.start[:-1])

    def row(self, i: int, width: int) -> np.ndarray:
        out = np.zeros(width, self.value.dtype)
        out[self.term[self.start[i] : self.start[i + 1]]] = self.value[self.start[i] : self.start[i + 1]]
        return out


class BallTree:
    """Centroids and radii of nested halves of the rows; rows are put in the order of the leaves."""

    def __init__(self, rows: Rows, width: int):
        floats = Rows(rows.start, rows.term, rows.value.astype(float))
        squares = np.add.reduceat(floats.value**2, floats.start[:-1])
        self.centroid, self.radius, self.children, self.span = [], [], [], []
        order = []
        todo = [(np.arange(len(squares)), None)]
        while todo:
            held, above = todo.pop()
            own = floats.take(held)
            node = len(self.centroid)
            if above is not None:
                self.children[above].append(node)
            middle = np.bincount(own.term, own.value, width) / len(held)
            scale = squares[held] + middle @ middle
            away = scale - 2 * own.dot(middle)
            # the subtraction errs by a tiny part of what it subtracts from
            self.centroid.append(middle)
            self.radius.append(math.sqrt(max(0.0, float(np.max(away + 1e-9 * scale)))))
            self.children.append([])
            if len(held) <= LEAF:
                self.span.append((len(order), len(order) + len(held)))
                order.extend(held.tolist())
                continue
            self.span.append(None)
            one = own.row(int(away.argmax()), width)
            other = own.row(int((squares[held] - 2 * own.dot(one)).argmax()), width)
            along = np.argsort(own.dot(other - one), kind="stable")
            half = len(held) // 2
            todo += [(held[along[:half]], node), (held[along[half:]], node)]
        self.order = np.array(order)
        self.rows = rows.take(self.order)
        self.centroid, self.radius = np.array(self.centroid), np.array(self.radius)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For every node and query at least the largest product with a row of the node, rounded up."""
        reach = np.sqrt((self.centroid > 0).astype(float) @ (queries**2).T)
        return (self.centroid @ queries.T + reach * self.radius[:, None]) * (1 + 1e-9) + 1


def _search_tree(tree: BallTree, bound: list[float], query: np.ndarray, best: list[tuple], k: int, ids: list) -> int:
    """Best-first search; ``best`` is a heap of ``(score, has id, -id)``. Returns the leaves scored."""
    opened, todo = 0, [(-bound[0], 0)]
    while todo:
        most, node = heapq.heappop(todo)
        if len(best) == k and -most < best[0][0]:
            break
        if tree.span[node] is None:
            for child in tree.children[node]:
                heapq.heappush(todo, (max(most, -bound[child]), child))
            continue
        opened += 1
        first, last = tree.span[node]
        start = tree.rows.start[first : last + 1]
        part = slice(start[0], start[-1])
        scores = np.add.reduceat(tree.rows.value[part] * query[tree.rows.term[part]], start[:-1] - start[0])
        least = best[0][0] if len(best) == k else 1
        for i in np.flatnonzero(scores >= max(least, 1)).tolist():
            key = ids[tree.order[first + i]]
            entry = (int(scores[i]), key is not None, -(key or 0))
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return opened


def _search(batches: Iterator[pa.RecordBatch], queries: list[tuple], weights: np.ndarray, documents: int, total: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best documents of a task for each query ``(query, id, places, times)``."""
    width = len(weights)
    best: list[list[tuple]] = [[] for _ in queries]
    most_documents = max(LEAF, LEAF // 2 * (NODE_CELLS // width))
    held: list[tuple] = []

    def search() -> None:
        ids = [i for h in held for i in h[0]]
        start = np.concatenate([[0], np.cumsum(np.concatenate([h[2] for h in held]))])
        length = np.repeat(np.concatenate([h[1] for h in held]), np.diff(start))
        term, times = (np.concatenate([h[i] for h in held]) for i in (3, 4))
        value = weights[term] * term_values(times, length, documents, total)
        tree = BallTree(Rows(start, term, value), width)
        together = max(1, QUERY_CELLS // width)
        for at in range(0, len(queries), together):
            some = queries[at : at + together]
            dense = np.zeros((len(some), width), np.int64)
            for row, (_, _, places, counts) in zip(dense, some, strict=True):
                row[places] = counts
            bounds = tree.bounds(dense.astype(float)).T.tolist()
            for i in range(len(some)):
                _search_tree(tree, bounds[i], dense[i], best[at + i], k, ids)
        held.clear()

    rows = entries = 0
    for batch in batches:
        places, times = batch.column(2), batch.column(3)
        for at in range(0, batch.num_rows, most_documents):
            part = slice(at, min(batch.num_rows, at + most_documents))
            size = part.stop - part.start
            terms_of, times_of = places.slice(at, size), times.slice(at, size)
            sizes = terms_of.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            if held and (rows + size > most_documents or entries + sizes.sum() > TREE_ENTRIES):
                search()
                rows = entries = 0
            held.append((
                batch.column(0).slice(at, size).to_pylist(), batch.column(1).slice(at, size).to_numpy(), sizes,
                terms_of.flatten().to_numpy().astype(np.int64), times_of.flatten().to_numpy().astype(np.int64),
            ))
            rows, entries = rows + size, entries + int(sizes.sum())
    if held:
        search()
    out = [(query, key, -entry[2] if entry[1] else None, entry[0]) for (query, key, _, _), own in zip(queries, best, strict=True) for entry in own]
    columns = list(zip(*out, strict=True)) or [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "id", "document", "score"])


# --- the operator -----------------------------------------------------------------


def _block(docs: DataFrame, queries: list[tuple], k: int) -> DataFrame | None:
    """The best documents of a block of queries, ``(query, id, names, times)`` each; None without documents."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for q in queries for t in q[2]}))}
    vectors = docs.mapInArrow(partial(_vectors, vocabulary=vocabulary), "id bigint, n bigint, terms array<int>, times array<int>")
    vectors = written(vectors.where("n > 0"), "vectors")
    documents, total = vectors.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    holding = np.zeros(len(vocabulary), np.int64)
    for place, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row per term of the block
        holding[place] = n
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in holding.tolist()], np.int64)
    placed = [(q, key, [vocabulary[t] for t in names], times) for q, key, names, times in queries]
    search = partial(_search, queries=placed, weights=weights, documents=documents, total=total, k=k)
    return vectors.where("size(terms) > 0").mapInArrow(search, "query bigint, id bigint, document bigint, score bigint")


def search(
    documents: DataFrame, queries: DataFrame, k: int = BEST, key: str = "doc_id", text: str = "text", query: str = "item_id", query_text: str = "text", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """``(query id, rank, document id, score)``: the ``k`` best documents with a score above 0 of every query, ids as bigints."""
    asked = queries.select(F.monotonically_increasing_id().alias("q"), F.col(query).cast("bigint").alias("id"), F.col(query_text).cast("string").cast("binary").alias("t"))
    asked = asked.mapInArrow(_query_terms, "query bigint, id bigint, terms array<binary>, times array<bigint>")
    asked = written(asked.where("size(terms) > 0"), "queries")
    docs = documents.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").cast("binary").alias("text"))
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms)
    found = []
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).collect()
        best = _block(docs, [(r.query, r.id, [bytes(t) for t in r.terms], list(r.times)) for r in some], k) if some else None
        if best is not None:
            found.append(written(best, "found") if blocks > 1 else best)
    columns = [F.col("id").alias(query), F.col("rank"), F.col("document").alias(key), F.col("score")]
    if not found:
        return asked.select("id", F.lit(0).alias("rank"), F.col("id").alias("document"), F.col("id").alias("score")).where("false").select(*columns)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("document"))
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select(*columns)
