"""Ranked search against a plain scorer; bounds of the trees."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from small_documents import documents  # noqa: F401

from retailmart.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    counted = [(key, Counter(terms(text))) for key, text in docs]
    counted = [(key, c) for key, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c in counted:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, times in Counter(terms(text)).items() if t in c)
            scores.append((-score, key is None, key or 0))
        scores = sorted(s for s in scores if s[0] < 0)[:k]
        out += [(item, r, None if none else key, -s) for r, (s, none, key) in enumerate(scores, 1)]
    return sorted(out, key=repr)


def test_terms():
    odd = "Ab1-cD É漢字x\u0085y\xa0z [\\]^_`{|}~ 0:9@A"
    assert [t.decode() for t in search.terms(odd.encode())] == terms(odd) and search.terms(None) == search.terms(b"") == []


def test_search(spark, documents):  # noqa: F811
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["É", "the"]
    draw = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, draw(rng.randint(1, 60))) for i in range(400)]
    docs += [(rng.randint(0, 399), docs[i][1]) for i in range(60)]  # repeated rows and ids, ties
    docs += [(None, docs[7][1]), (None, docs[7][1]), (900, None), (901, "?! ,"), (902, "W1. " * 30_000), (903, "THE"), (-5, docs[7][1])]
    items = [(i, draw(rng.randint(1, 30))) for i in range(40)] + [(1, "w59 w59 w3"), (None, "w1 w2"), (77, None), (78, "--"), (79, "unknown"), (80, docs[7][1])]
    df = documents(*docs, extra=("score", "rank", "n")).repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1)).repartition(2)
    for k, block in ((10, search.BLOCK_TERMS), (3, 150)):
        got = sorted((tuple(r) for r in search.search(df, asked, k, block_terms=block).collect()), key=repr)
        assert got == brute_search(docs, items, k)
    assert search.search(df.limit(0), asked).count() == search.search(df, asked.limit(0)).count() == search.search(df, asked.where("item_id = 78")).count() == 0


def test_bounds_and_pruning():
    """No bound lies under a product below it; far trees are left out, and small trees agree with large ones."""
    rng = np.random.default_rng(4)
    width, n = 400, 3000
    sets = [np.sort(rng.choice(40, 12, replace=False)) + 40 * (i % 10) for i in range(n)]  # ten topics
    start = np.arange(n + 1) * 12
    rows = search.Rows(start, np.concatenate(sets), rng.integers(1, 10**10, 12 * n))
    tree = search.BallTree(rows, width)
    queries = np.zeros((20, width), np.int64)
    for i, q in enumerate(queries):
        q[rng.choice(40, 6) + 40 * (i % 10)] = rng.integers(1, 4, 6)
    bounds = tree.bounds(queries.astype(float))
    products = np.array([tree.rows.dot(q) for q in queries])

    def under(node):
        if tree.span[node]:
            return [node]
        return [x for c in tree.children[node] for x in under(c)]

    opened = 0
    for node in range(len(tree.span)):
        leaves = [tree.span[x] for x in under(node)]
        inside = np.concatenate([products[:, a:b] for a, b in leaves], axis=1)
        assert (bounds[node] >= inside.max(axis=1)).all()
    for i, q in enumerate(queries):
        best = []
        opened += search._search_tree(tree, bounds[:, i].tolist(), q, best, 10, list(range(n)))
        want = sorted(((int(s), -int(tree.order[j])) for j, s in enumerate(products[i]) if s > 0), reverse=True)[:10]
        assert sorted(((s, d) for s, _, d in best), reverse=True) == want
    assert opened < 0.25 * 20 * sum(s is not None for s in tree.span)
