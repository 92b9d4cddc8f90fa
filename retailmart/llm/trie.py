"""Prefix tree of conversations: ROLLUP over positional turn columns finds all prefixes together.

Every turn becomes one short name, a digest of role and text with the text's length behind it. A
conversation is laid out in blocks of ``width`` turns, one row a block with a column for each position, and one ROLLUP
over these columns groups by every prefix at once: ``grouping_id`` tells how many positions
a group holds, so a group is a node. Blocks after a conversation's first one are also grouped by the
node in which the block before ended. A node's name is a digest of its block's key and its turns, so that
key is known from the conversation alone, and a conversation of any length adds rows but no rounds.

Sums over subtrees need no walk through the levels either. The smallest member of a node represents it; as
members only get fewer on the way down, a conversation represents the nodes of its path from some
depth on. Each node is thus counted once with its representative, a leaf with the conversation that
ends there, and a second ROLLUP over the representatives sums both up for every prefix.

All members of a node are counted and summed inside the tasks before they are shuffled, also where one node holds
a third of all conversations. The digest over a node's conversations runs in their order: sorted pieces of the list
are made in all tasks, and one task's stream hashes the pieces of a node.

Defined results: NULL role and text are empty; turns are ordered with NULL first, rows of one turn by role and text, and
repeated rows are turns of their own; a row without a conversation belongs to none; no conversations give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailmart.llm.text import filled
from retailmart.sources.scratch import written

WIDTH = 8  # turns in a block
NAME = 32  # hexadecimal digits of a name
LIST_BYTES = 1 << 16  # a piece of a list of conversations


def turn_name(role: Column, text: Column) -> Column:
    """Digest of role and text, a colon, and the code points of the text."""
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(whole, 256), 1, NAME), F.lit(":"), F.char_length(text).cast("string"))


def _code_points(name: Column) -> Column:
    return F.coalesce(F.substring(name, NAME + 2, 20).cast("bigint"), F.lit(0).cast("bigint"))


def _turn_columns(width: int) -> list[str]:
    return [f"t{i}" for i in range(width)]


def _with_keys(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The key of every block of sorted conversations: the name of the node that the block before ends in."""
    now, key = object(), ""
    for batch in batches:
        columns = batch.to_pydict()
        keys = []
        for conv, *turns in zip(columns["conv"], *(columns[c] for c in _turn_columns(width)), strict=True):
            if conv != now:
                now, key = conv, ""
            keys.append(key)
            key = hashlib.sha256("/".join([key, *(t for t in turns if t)]).encode()).hexdigest()[:NAME]
        yield batch.set_column(batch.schema.get_field_index("key"), "key", pa.array(keys, pa.string()))


def blocks(df: DataFrame, members: DataFrame | None, conversation: str, turn: str, role: str, text: str, width: int) -> DataFrame:
    """``conv, key, at, t0..., n, total, before``: a row per block; ``at`` turns come before it, with ``before`` code points."""
    rows = df.select(F.col(conversation).cast("bigint").alias("conv"), F.col(turn).alias("turn"), filled(role).alias("role"), filled(text).alias("text")).where("conv is not null")
    of = Window.partitionBy("conv")
    order = of.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    long = F.char_length("text").cast("bigint")
    named = rows.select("conv", "turn", "role", "text", turn_name(F.col("role"), F.col("text")).alias("name"), long.alias("long"))
    names = _turn_columns(width)
    named = named.select(
        "conv", F.lit("").alias("key"), (F.row_number().over(order) - 1).cast("bigint").alias("at"),
        *[F.lead("name", i).over(order).alias(c) for i, c in enumerate(names)],
        F.count("*").over(of).alias("n"), F.sum("long").over(of).alias("total"),
        F.coalesce(F.sum("long").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    ).where(F.col("at") % width == 0)
    if members is not None:
        empty = members.select(F.col(conversation).cast("bigint").alias("conv")).where("conv is not null").distinct().join(rows.select("conv"), "conv", "left_anti")
        zero = F.lit(0).cast("bigint")
        nothing = [F.lit(None).cast("string").alias(c) for c in names]
        named = named.unionByName(empty.select("conv", F.lit("").alias("key"), zero.alias("at"), *nothing, zero.alias("n"), zero.alias("total"), zero.alias("before")))
    named = written(named, "blocks")
    several = named.where(F.col("n") > width).repartition("conv").sortWithinPartitions("conv", "at")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _with_keys(batches, width)

    return named.where(F.col("n") <= width).unionByName(several.mapInArrow(keyed, named.schema))


def _rolled(rows: DataFrame, sums: dict[str, str], width: int) -> DataFrame:
    """A row per node: its name, its parent's, its depth, its turn's code points, those of its path, and ``sums``."""
    names = _turn_columns(width)
    wanted = ", ".join(f"{expression} as {name}" for name, expression in sums.items())
    grouped = rows.sparkSession.sql(
        f"""select key, {", ".join(names)}, {width} - bit_count(grouping_id()) as level, max(at) as at, max(before) as before, {wanted}
        from {{rows}} group by key, rollup ({", ".join(names)})""",
        rows=rows,
    )
    turns = F.array(*[F.col(c) for c in names])
    # a conversation that ends inside the block has no turn at the deeper levels
    nodes = grouped.where(((F.col("level") == 0) & (F.col("key") == "")) | F.get(turns, F.col("level") - 1).isNotNull())

    def node(level: Column) -> Column:
        path = F.array_join(F.concat(F.array("key"), F.slice(turns, F.lit(1), level)), "/")
        return F.when(level > 0, F.substring(F.sha2(path, 256), 1, NAME)).otherwise(F.col("key"))

    along = F.aggregate(F.transform(turns, _code_points), F.lit(0).cast("bigint"), lambda total, n: total + n)
    return nodes.select(
        node(F.col("level")).alias("node"),
        F.when(F.col("level") > 0, node(F.greatest(F.col("level") - 1, F.lit(0)))).alias("parent"),
        (F.col("at") + F.col("level")).cast("bigint").alias("depth"),
        F.coalesce(_code_points(F.get(turns, F.col("level") - 1)), F.lit(0)).alias("long"),
        (F.col("before") + along).alias("path"),
        *sums,
    )


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``(node, conv)`` to ``(node, first, list)``: comma-joined pieces of bounded size."""
    now, first, text, size = None, None, [], 0

    def out(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)], ["node", "first", "list"])

    for batch in batches:
        done = []
        for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text and (node != now or size >= LIST_BYTES):
                done.append((now, first, ",".join(text)))
                text, size = [], 0
            if not text:
                now, first = node, conv
            text.append(str(conv))
            size += len(text[-1]) + 1
        yield out(done)
    if text:
        yield out([(now, first, ",".join(text))])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of lists to ``(node, ends_sha256)``; a piece is held at a time."""
    now, digest = None, None

    def out(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["node", "ends_sha256"])

    for batch in batches:
        done = []
        for node, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if digest is not None and node != now:
                done.append((now, digest.hexdigest()))
                digest = None
            if digest is None:
                now, digest = node, hashlib.sha256(piece.encode())
            else:
                digest.update(("," + piece).encode())
        yield out(done)
    if digest is not None:
        yield out([(now, digest.hexdigest())])


def _ends(rows: DataFrame, width: int) -> DataFrame:
    """``(node, ends_sha256)`` for nodes in which conversations end."""
    last = rows.where(F.col("n") - F.col("at") <= width)
    path = F.concat_ws("/", "key", *_turn_columns(width))
    node = F.when(F.col("n") > 0, F.substring(F.sha2(path, 256), 1, NAME)).otherwise(F.col("key"))
    ends = last.select(node.alias("node"), "conv")
    lists = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(_lists, "node string, first bigint, list string")
    return lists.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node string, ends_sha256 string")


def prefix_tree(
    df: DataFrame, members: DataFrame | None = None, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", width: int = WIDTH
) -> DataFrame:
    """One row per node: its smallest member, depth, parent, members, children, leaves, savings, and who ends in it.

    ``members`` lists the conversations where some may have no turns. ``node`` and ``parent`` are names of nodes,
    equal in every run. ``saved_tokens`` is what storing each shared text of the subtree once saves, in code points.
    """
    rows = written(blocks(df, members, conversation, turn, role, text, width), "turns")
    found = _rolled(rows, {"conv_id": "min(conv)", "n_convs": "count(*)", "total": "sum(total)", "longest": "max(n)"}, width)
    own = Window.partitionBy("conv_id")  # the nodes that a conversation represents, at most its turns and the root
    nodes = found.select(
        "*", (F.col("path") - F.col("long")).alias("above"), F.min("depth").over(own).alias("from_depth"),
        F.min(F.col("path") - F.col("long")).over(own).alias("from_path"), (F.col("longest") == F.col("depth")).alias("leaf"),
    )
    nodes = written(nodes, "nodes")
    represented = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.sum("long").alias("own"), F.sum(F.col("leaf").cast("int")).alias("leaf"))
    second = _rolled(rows.join(represented, "conv"), {"own": "sum(own)", "n_leaves": "sum(leaf)"}, width).select("node", "own", "n_leaves")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nothing = hashlib.sha256().hexdigest()
    full = nodes.join(second, "node").join(children, "node", "left").join(_ends(rows, width), "node", "left")
    copies = F.col("total") - F.col("n_convs") * F.col("above")
    once = F.col("own") - (F.col("above") - F.col("from_path"))
    full = full.select(
        "node", "parent", "conv_id", "depth", "from_depth", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        (copies - once).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
    full = written(full, "tree")
    # below the first node that a conversation represents it also represents the parent
    within = full.withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id"))).where("depth > from_depth or depth = 0")
    above = full.select(F.col("node").alias("__node"), F.col("conv_id").alias("parent_conv_id"))
    first = full.where("depth = from_depth and depth > 0").join(above, F.col("parent") == F.col("__node"))
    columns = ["node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return within.select(*columns).unionByName(first.select(*columns))
