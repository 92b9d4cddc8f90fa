"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.sources.scratch import written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task: every node with the smallest node it is joined to."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    joined = [(x, root(x)) for x in parent]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, y in joined if x != y], pa.int64()), pa.array([y for x, y in joined if x != y], pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the links ``(a, b)`` of bigints; the label is the smallest node reachable.

    Each task first joins its own links by union-find, which leaves fewer links than
    nodes. Then every node takes the smallest label among its neighbours and follows that
    label's label, until nothing changes. Each round is a written table; the driver
    sees a count. Links of a node to itself and repeated links do no harm; no links give no rows.
    """
    trees = links.select("a", "b").where("a <> b").mapInArrow(_forest, "a bigint, b bigint")
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    edges = written(trees.select(both.alias("e")).select("e.a", "e.b").distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "low").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        new = written(lower.join(jump, "via").select("node", "old", F.least("via", "far").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels
