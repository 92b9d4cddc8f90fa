"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, tokens."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmart.llm import minhash, mixing, pii, quality, segment
from retailmart.llm.queries import KEY, vocabulary_file
from retailmart.sources.scratch import removed_at_end, shared_folder

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, the length as the text now is."""
    return df.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*DOCUMENTS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the rules reject; frequent lines of a host leave the texts that stay."""
    judged = quality.judge(docs.select(*DOCUMENTS)).where("kept")
    return _documents(judged.withColumn("text", F.col("left_text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five words, 0.8): the first of its smallest id."""
    return _documents(minhash.without_duplicates(docs.select(*DOCUMENTS)))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in every text."""
    return _documents(pii.pseudonymize(docs.select(*DOCUMENTS), KEY))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mixing.mix(docs.select(*DOCUMENTS)).where("copies > 0")
    return _documents(mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The best segmentation of every row, how far the next ones are behind, and the digest of the text that they decode to."""
    found = segment.encode(docs.select(*DOCUMENTS), vocabulary_file(), read_back=True)
    return found.select(
        "doc_id", "lang", "source", "n_chars", F.size("ids").cast("bigint").alias("n_pieces"), "score", "ids", "others",
        "decoded_chars", "decoded_sha256", "others_agree",
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written in the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        removed_at_end(spark, path)
        docs = spark.read.parquet(path)
    return docs


ORACLE_SQL = None
