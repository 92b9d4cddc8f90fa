"""The prefix tree against a plain version that builds every prefix."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from retailmart.llm import trie

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_tree(rows, members=()):
    turns = defaultdict(list, {c: [] for c in members})
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {c: tuple(t[2:] for t in sorted(own)) for c, own in turns.items()}
    held = defaultdict(list)
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            held[path[:d]].append(conv)
    children = defaultdict(set)
    for path in held:
        if path:
            children[path[:-1]].add(path)

    def below(path):
        return [path] + [y for x in children[path] for y in below(x)]

    out = []
    for path, convs in held.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if paths[c] == path))
        saved = sum((len(held[x]) - 1) * len(x[-1][1]) for x in below(path) if x)
        leaves = sum(not children[x] for x in below(path))
        parent = min(held[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children[path]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def tree(df, members=None, **options):
    return sorted((tuple(r) for r in trie.prefix_tree(df, members, **options).select(*COLUMNS).collect()), key=repr)


def test_shared_prefixes(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(-20, 60):
        for turn in range(rng.choice((1, 2, 3, 4, 5, 9))):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], rng.choice(("", "a", "éé", "long text /:1"))))
    rows += [(c, t, "user", f"t{t % 3}") for c in (100, 101, 102) for t in range(37 + (c == 101))]
    members = spark.createDataFrame([(c,) for c in [*range(-25, 60), 100, 101, 102]], "conv_id bigint")
    df = spark.createDataFrame(rows, TURNS).withColumn("key", F.lit("clash")).withColumn("t0", F.lit("clash")).repartition(5)
    assert tree(df, members) == brute_tree(rows, [r.conv_id for r in members.collect()])
    assert tree(df, width=3) == brute_tree(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "a"), (1, 1, None, None), (2, None, "user", "a"), (2, 1, "", ""), (2, 1, "", ""), (3, 5, None, "x" * 100_000),
        (None, 0, "user", "nobody's"), (4, 1, "user", "b"), (4, 1, "assistant", "b"), (5, 1, "assistant", "b"), (5, 2, "user", "b"), (6, 1, "user\na", ""), (7, 1, "user", "\na"),
    ]
    df = spark.createDataFrame(rows, TURNS)
    assert tree(df) == brute_tree(rows)
    assert tree(df.limit(0)) == []
    nobody = df.limit(0).select("conv_id")
    assert tree(df.limit(0), nobody.union(spark.createDataFrame([(9,), (8,), (8,)], "conv_id bigint"))) == brute_tree([], [8, 9])


def test_lists_in_pieces(spark, monkeypatch):
    """A list longer than a piece hashes like the whole."""
    monkeypatch.setattr(trie, "LIST_BYTES", 40)
    rows = [(c, 0, "user", "same") for c in range(990, 1200)] + [(c, 0, "user", str(c % 3)) for c in range(50)]
    assert tree(spark.createDataFrame(rows, TURNS).repartition(3)) == brute_tree(rows)
