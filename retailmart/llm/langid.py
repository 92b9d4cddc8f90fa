"""Language identification with a string kernel.

A text is the set of its letter n-grams of one to four characters, words bordered by a blank (a blended
spectrum, presence only). The kernel of two texts is the number of n-grams they share over the root of
the product of their sizes. Nystroem landmarks, a few texts of each language, turn a text
into a short vector: its kernels with them, whitened. One ridge regression per language against the
rest is fitted on those vectors, and whole batches are scored by matrix products: presence matrix times
landmark matrix times weights.

The model is fitted on at most ``per_language`` labelled texts (the smallest by hash) of at most
``most_languages`` languages (the commonest); both bounds are parameters. Executors send
the driver only n-gram codes of these texts. Every text is scored whole, in pieces that overlap.

Letters are told apart up to 253 that the sample uses most; all others count as one.

Defined results: NULL text, or text without a letter: ``und``, score 0; no labelled rows: every text
is ``und``; ties go to the language that sorts first; repeated rows are scored alike; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N = 4
PER_LANGUAGE, LANDMARKS, MOST_LANGUAGES, RIDGE = 80, 32, 200, 1e-2
_PIECE = 1 << 20  # characters whose n-grams are made at once
_BATCH = 256
UNKNOWN = "und"


def _classes(alphabet: str) -> np.ndarray:
    """Class of every code point: 1 for a blank, 2 for an unlisted letter, then the alphabet; letters are found by case or category."""
    out = np.ones(0x110000, np.uint8)
    for block in range(0, 0x110000, 0x10000):
        if block not in (0xE0000, 0xF0000, 0x100000):
            out[block : block + 0x10000] = [2 if chr(i).isalpha() else 1 for i in range(block, block + 0x10000)]
    for i, c in enumerate(alphabet):
        out[ord(c)] = 3 + i
    return out


def grams(text: str, classes: np.ndarray) -> np.ndarray:
    """Sorted distinct codes of the text's n-grams; empty if it has no letter."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = classes[points]
    kinds = kinds[np.concatenate([[True], (kinds[1:] != 1) | (kinds[:-1] != 1)])]  # one blank between words
    if not (kinds > 1).any():
        return np.empty(0, np.uint32)
    found = []
    for start in range(0, len(kinds), _PIECE):
        piece = kinds[start : start + _PIECE + N - 1].astype(np.uint32)
        codes = piece
        for n in range(1, N + 1):
            if n > 1:
                codes = (codes[:-1] << np.uint32(8)) | piece[n - 1 :]
            ordered = np.sort(codes)
            found.append(ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered)
    return np.unique(np.concatenate(found)) if len(kinds) > _PIECE else np.concatenate(found)


@dataclass
class Model:
    alphabet: str
    languages: list[str]
    vocabulary: np.ndarray  # sorted codes of all landmarks
    landmarks: np.ndarray  # presence, vocabulary x landmarks, each over the root of its size
    weights: np.ndarray  # landmarks x languages: whitening and regression in one

    def kernels(self, sets: list[np.ndarray]) -> np.ndarray:
        """Kernels of the texts with the landmarks."""
        present = np.zeros((len(sets), len(self.vocabulary)), np.float32)
        for i, codes in enumerate(sets):
            at = np.minimum(np.searchsorted(self.vocabulary, codes), len(self.vocabulary) - 1)
            present[i, at[self.vocabulary[at] == codes]] = 1 / np.sqrt(max(1, len(codes)))
        return present @ self.landmarks

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        return self.kernels(sets) @ self.weights


def fit(texts: list[tuple[str, np.ndarray]], alphabet: str, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """A model from labelled code sets; the first of each language are its landmarks."""
    languages = sorted({lang for lang, _ in texts})
    seen: Counter = Counter()
    chosen = []
    for lang, codes in texts:
        if seen[lang] < landmarks:
            chosen.append(codes)
        seen[lang] += 1
    vocabulary = np.unique(np.concatenate(chosen))
    matrix = np.zeros((len(vocabulary), len(chosen)), np.float32)
    for i, codes in enumerate(chosen):
        matrix[np.searchsorted(vocabulary, codes), i] = 1 / np.sqrt(len(codes))
    model = Model(alphabet, languages, vocabulary, matrix, np.eye(len(chosen), dtype=np.float32))
    values, vectors = np.linalg.eigh((matrix.T @ matrix).astype(np.float64))
    strong = values > 1e-6 * values.max()
    whiten = vectors[:, strong] / np.sqrt(values[strong])
    mapped = np.vstack([model.kernels([c for _, c in texts[i : i + _BATCH]]) for i in range(0, len(texts), _BATCH)]) @ whiten
    wanted = np.array([[1.0 if lang == x else -1.0 for x in languages] for lang, _ in texts])
    # every language weighs the same
    balance = np.array([1 / seen[lang] for lang, _ in texts])[:, None] * len(texts) / len(languages)
    normal = mapped.T @ (balance * mapped) + ridge * len(texts) * np.eye(mapped.shape[1])
    model.weights = (whiten @ np.linalg.solve(normal, mapped.T @ (balance * wanted))).astype(np.float32)
    return model


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column(0):
            counts.update(text.as_py().lower())
        found = [(c, n) for c, n in counts.items() if c.isalpha() and len(c) == 1]
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["letter", "n"])


def _coded(batches: Iterator[pa.RecordBatch], alphabet: str) -> Iterator[pa.RecordBatch]:
    classes = _classes(alphabet)
    for batch in batches:
        codes = [grams(text.as_py(), classes).astype(np.int64) for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.list_(pa.int64()))], ["lang", "codes"])


def train(
    labelled: DataFrame, key: str, text: str, lang: str, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, most_languages: int = MOST_LANGUAGES
) -> Model | None:
    """Fit on a bounded sample; None if no labelled text has a letter.

    The sample is picked by the hash of the key, per language, each task keeping no more than it may need;
    only then are texts read.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    common = rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages)
    names = [r.lang for r in common.collect()]
    if not names:
        return None
    from pyspark.sql import Window

    order = Window.partitionBy(lang).orderBy(F.xxhash64(key), F.col(key))
    picked = rows.where(F.col(lang).isin(names)).select(key, lang).withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= per_language)
    picked = picked.select(F.col(key).alias("__key"), F.col("__rank")).collect()
    ranks = {r["__key"]: r["__rank"] for r in picked}
    sample = rows.where(F.col(key).isin(list(ranks))).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key).alias("h")).repartition(4)
    letters = sample.select("text").mapInArrow(_letters, "letter string, n bigint").groupBy("letter").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "letter")
    alphabet = "".join(sorted(r.letter for r in letters.limit(253).collect()))
    coded = sample.orderBy("lang", "h").select("lang", "text").mapInArrow(partial(_coded, alphabet=alphabet), "lang string, codes array<bigint>").collect()
    texts = sorted(((r.lang, np.array(r.codes, np.uint32)) for r in coded), key=lambda x: (x[0], len(x[1]), x[1].tobytes()))
    # landmarks are the texts of middling size first
    texts.sort(key=lambda x: (x[0], abs(len(x[1]) - 1000)))
    return fit([x for x in texts if len(x[1])], alphabet, landmarks)


def _predicted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    classes = _classes(model.alphabet)

    def out(ids: list, sets: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        full = [s for s in sets if len(s)]
        scores = model.scores(full) if full else np.empty((0, len(model.languages)))
        # regression targets are -1 and 1
        best = iter([(model.languages[int(row.argmax())], float(np.clip((row.max() + 1) / 2, 0, 1))) for row in scores])
        said = [next(best) if len(s) else (UNKNOWN, 0.0) for s in sets]
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array([x for x, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())], ["place", "lang_pred", "score"])

    for batch in batches:
        ids, sets = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(key)
            sets.append(grams(text.as_py() or "", classes))
            if len(ids) == _BATCH:
                yield out(ids, sets, batch.schema.field(0).type)
                ids, sets = [], []
        if ids:
            yield out(ids, sets, batch.schema.field(0).type)


def identify(df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(<key>, lang_pred, score)`` per row, from the text alone."""
    if model is None:
        return df.select(key, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key), F.col(text).cast("string"))
    return rows.mapInArrow(partial(_predicted, model=model), f"place {kind}, lang_pred string, score double").withColumnRenamed("place", key)
