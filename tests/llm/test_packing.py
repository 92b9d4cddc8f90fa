"""Pieces of tokens against the vocabulary's own library, packings against their limits and a one-by-one best fit."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from small_documents import documents  # noqa: F401
from tokenizers import Tokenizer

from retailmart.llm import packing
from retailmart.llm.queries import TOKENIZERS, byte_vocabulary

ODD = [
    "", None, " ", "\n\n a  b\t\tc  d e", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>", "it's 12,345 ÉÀ 漢字 🙂🙂", "a" * 9000, " " * 120_000 + "b",
    "\n" * 70_000, "one two three. " * 3000, "\x00\x1c\x85", "é don't we'll", "word " * 2047, "word " * 2048,
]


def test_pieces(spark, documents):  # noqa: F811
    exact = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    texts = [*ODD, *(r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())]
    df = documents(*enumerate(texts), extra=("piece", "ids"))
    got = packing.token_pieces(df, *byte_vocabulary(), with_ids=True).collect()
    want = []
    for i, text in enumerate(texts):
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 0]
        head = len(ids) if len(ids) <= 2048 else len(ids) % 2048
        parts = [ids[:head]] * (head > 0) + [ids[a : a + 2048] for a in range(head, len(ids), 2048)]
        start = 0
        for n, part in enumerate(parts):
            want.append((i, n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
            start += len(part)
    assert sorted(tuple(r) for r in got) == want
    assert packing.token_pieces(df.limit(0), *byte_vocabulary()).count() == 0


def check_packed(rows, capacity):
    """Gapless sequences within the capacity; their number."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def one_by_one(lengths, rooms, capacity):
    """Best fit, longest first, one after the other."""
    rooms = list(rooms)
    for length in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def test_planned_best_fit_is_the_one_by_one_run():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice((10, 50, 211))
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 300))), reverse=True)
        rooms = sorted(rng.randint(0, capacity) for _ in range(rng.randint(0, 40)))
        counts = np.bincount(lengths, minlength=capacity + 1)
        ranges = packing.plan_rest(counts, [(0, len(lengths))], np.bincount(rooms, minlength=capacity + 1), capacity)
        left = dict(enumerate(rooms))
        seen = []
        for start, stop, per, base in ranges:
            for rank in range(start, stop):
                sequence = base + (rank - start) // per
                left[sequence] = left.get(sequence, capacity) - lengths[rank]
                seen.append(rank)
        assert sorted(seen) == list(range(len(lengths)))
        assert sorted(left.values()) == one_by_one(lengths, rooms, capacity)


def test_configurations_meet_the_demand():
    sizes, demand = np.array([45, 36, 31, 14]), np.array([97.0, 610.0, 395.0, 211.0])
    columns, use = packing.configurations(sizes, demand, 100)
    assert (sizes @ columns <= 100).all()
    np.testing.assert_allclose(columns @ use, demand)
    assert use.sum() == pytest.approx(452.25, rel=2e-3)  # what all configurations give


@pytest.mark.parametrize("spread", ["even", "hot", "halves"])
def test_packed(spark, spread):
    rng = random.Random(spread)
    draw = {"even": lambda: rng.randint(1, 100), "hot": lambda: rng.choice((41, 41, rng.randint(1, 100), 100)), "halves": lambda: rng.choice((51, 50, 49))}[spread]
    lengths = [draw() for _ in range(6000)]
    df = spark.createDataFrame([(i % 5900 or None, n, "x", 0) for i, n in enumerate(lengths)], "id bigint, length bigint, sequence_id string, offset int").repartition(7)
    rows = packing.pack(df, capacity=100).collect()
    assert sorted((r.id or 0, r.length) for r in rows) == sorted((i % 5900, n) for i, n in enumerate(lengths))
    best = len(one_by_one(lengths, [], 100))
    assert check_packed(rows, 100) <= max(best * 1.02, best + 3)


def test_odd_lengths(spark):
    df = spark.createDataFrame([(1, 5), (2, 1)], "id bigint, length bigint")
    assert check_packed(packing.pack(df, capacity=5).collect(), 5) == 2
    assert packing.pack(df.limit(0), capacity=5).count() == 0
    for wrong in (0, 6, None):
        with pytest.raises(Exception, match="a length outside 1 to 5"):
            packing.pack(df.withColumn("length", F.lit(wrong).cast("bigint")), capacity=5)
