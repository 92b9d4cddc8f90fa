"""Quality rules: text measures per document and line frequency across the documents of a host.

Lines are compared by their normal form: lower case, every digit as 0, blanks
collapsed. A line that stands in more than a limit of distinct documents of its host is page furniture
and is removed; a document that consists mostly of such lines is rejected.

Distinct documents are those that differ in the set of their lines, so exact copies count once. Near copies are
distinct documents: where a host has more of them than the limit, the lines they share go. Finding
near copies is the business of another operator; remove them first where they are to count once.

The limit is a number of documents, whatever the host holds. Flagged lines are rows of ``(host, line)``, joined to the
lines of the documents, and a document's flagged lines come back to it as one row. Lines are counted
inside the tasks before they are shuffled, and equal texts are one row until then.

Defined results: NULL text counts as empty; an empty text has no words and fails
the base rule; rows with NULL host form one host; repeated rows are judged alike
and count as one document; an empty table gives an empty result. Line keys are
64-bit hashes, so two different lines of a host may by rare chance be counted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmart.llm.text import WORD, filled, words
from retailmart.sources.scratch import written

MIN_WORDS = 50  # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50  # base rule: more words in repeated three-word windows fail
MAX_DOCUMENTS = 20  # a line in more documents of its host goes
MIN_LEFT = 0.3  # a document must keep this share of its words
SYMBOLS = "[#*$%&|<>]"


def _held(flag: Column) -> Column:
    """The flag with a part that depends on the row's place and is always true.

    A filter on a flag is else moved below the steps that make it, each step written out inside
    the next, and computed again for every element of the lists that the steps run through.
    """
    return flag & (F.monotonically_increasing_id() >= 0)


def _covered(words_column: str) -> list[tuple[str, Column]]:
    """Steps that count the words lying in a three-word window found twice or more.

    Windows are sorted by a 32-bit hash with the position below it; neighbours of
    equal hash are candidates, and only those are compared word by word.
    """
    w = F.col(words_column)

    def high(x: Column) -> Column:
        return F.shiftright(x, 32)

    def neighbours(array: str, same):
        a = F.col(array)
        return F.filter(a, lambda x, i: F.coalesce(same(x, F.get(a, i - 1)), F.lit(False)) | F.coalesce(same(x, F.get(a, i + 1)), F.lit(False)))

    def packed(i: Column) -> Column:
        hashed = F.hash(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).cast("bigint")
        return F.shiftleft(hashed, 32).bitwiseOR(i.cast("bigint"))

    def window(x: Column) -> Column:
        at = x.bitwiseAND(0xFFFFFFFF).cast("int")
        return F.struct(F.get(w, at).alias("a"), F.get(w, at + 1).alias("b"), F.get(w, at + 2).alias("c"), at.alias("at"))

    starts = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    return [
        ("__starts", starts),
        ("__windows", F.sort_array(F.transform("__starts", packed))),
        ("__alike", neighbours("__windows", lambda x, y: high(x) == high(y))),
        ("__compared", F.sort_array(F.transform("__alike", window))),
        ("__equal", neighbours("__compared", lambda x, y: (x.a == y.a) & (x.b == y.b) & (x.c == y.c))),
        ("__places", F.sort_array(F.transform("__equal", lambda x: x["at"]))),
        (
            "n_repeat_words",
            F.aggregate(
                F.transform("__places", lambda p, i: F.least(F.coalesce(F.get(F.col("__places"), i + 1) - p, F.lit(3)), F.lit(3))),
                F.lit(0).cast("bigint"),
                lambda total, n: total + n,
            ),
        ),
    ]


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to every row."""
    kept = [c for c in df.columns if c not in MEASURES]
    out = df.select(*kept, filled(text).alias("__text"))
    out = out.select(*kept, "__text", words(F.col("__text")).alias("__words"), F.filter(F.split("__text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"))
    have = [*kept, "__text", "__words", "__lines"]
    for name, step in _covered("__words"):
        out = out.select(*have, step.alias(name))
    long = lambda c: c.cast("bigint")
    out = out.select(
        *kept,
        long(F.size("__words")).alias("n_words"),
        long(F.char_length(F.array_join("__words", ""))).alias("word_chars"),
        long(F.regexp_count("__text", F.lit(SYMBOLS))).alias("n_symbols"),
        long(F.size("__lines") - F.size(F.array_distinct("__lines"))).alias("n_dup_lines"),
        "n_repeat_words",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", _held(failed))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def normal_lines(text: Column) -> Column:
    """The lines of a text in normal form, in order and as many as the text has."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[1-9]", "0"), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(plain, "\n", -1), lambda x: F.trim(x))


def _identity(text: str) -> list[Column]:
    """Two independent hashes that stand for a whole text."""
    return [F.xxhash64(filled(text)).alias("__first"), F.xxhash64(F.lit("other"), filled(text)).alias("__second")]


def text_lines(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``(host, __first, __second, keys, lines)`` per distinct text of a host, as a written table.

    ``keys`` are the distinct keys of its lines; ``lines`` has every line that is not blank with its key and number of words.
    """
    rows = df.select(F.col(host).alias("host"), *_identity(text), F.split(filled(text), "\n", -1).alias("plain"), normal_lines(filled(text)).alias("normal"))
    line = F.zip_with("plain", "normal", lambda x, y: F.when(y != "", F.struct(F.xxhash64(y).alias("key"), F.regexp_count(x, F.lit(WORD)).cast("bigint").alias("words"))))
    rows = rows.select("host", "__first", "__second", F.filter(line, lambda x: x.isNotNull()).alias("lines")).where("size(lines) > 0")
    rows = rows.dropDuplicates(["host", "__first", "__second"])
    return written(rows.select("*", F.array_sort(F.array_distinct(F.col("lines.key"))).alias("keys")), "lines")


def frequent_lines(lines: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """``(host, key, documents)`` of the lines in more than ``max_documents`` distinct documents of their host, as a written table."""
    documents = lines.select("host", "keys").withColumn("set", F.xxhash64("keys")).dropDuplicates(["host", "set"])
    counted = documents.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("documents"))
    return written(counted.where(F.col("documents") > max_documents), "frequent")


def judge(df: DataFrame, text: str = "text", host: str = "source", max_documents: int = MAX_DOCUMENTS, min_left: float = MIN_LEFT) -> DataFrame:
    """All rows with their measures, ``left_words``, ``left_text`` without the flagged lines, and ``kept``.

    ``kept`` is false where the base rule fails or less than ``min_left`` of the words
    is left. Columns of these names in the input are replaced.
    """
    lines = text_lines(df, text, host)
    frequent = frequent_lines(lines, max_documents).select(F.col("host").alias("__of"), F.col("key").alias("__key"))
    spread = lines.select("host", "__first", "__second", F.inline("lines"))
    lost = spread.join(frequent, F.col("host").eqNullSafe(F.col("__of")) & (F.col("key") == F.col("__key")))
    lost = lost.groupBy(F.col("host").alias("__host"), F.col("__first").alias("__a"), F.col("__second").alias("__b"))
    # a text has as many flagged lines as it has lines at most
    lost = written(lost.agg(F.sum("words").alias("__lost"), F.collect_set("key").alias("__flags")), "lost")

    added = ("left_words", "left_text", "kept")
    measured = measure(df, text).drop(*added)
    columns = measured.columns
    same = F.col(host).eqNullSafe(F.col("__host")) & (F.col("__first") == F.col("__a")) & (F.col("__second") == F.col("__b"))
    out = measured.select("*", *_identity(text)).join(lost, same, "left")
    out = out.select(*columns, "__flags", F.coalesce("__lost", F.lit(0)).alias("__lost"))
    left = F.filter(
        F.zip_with(F.split(filled(text), "\n", -1), normal_lines(filled(text)), lambda x, y: F.when((y == "") | ~F.array_contains("__flags", F.xxhash64(y)), x)),
        lambda x: x.isNotNull(),
    )
    left_text = F.when(F.col("__flags").isNull(), filled(text)).otherwise(F.array_join(left, "\n"))
    out = out.select(*columns, left_text.alias("left_text"), (F.col("n_words") - F.col("__lost")).alias("left_words"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("left_words") >= min_left * F.col("n_words")))
