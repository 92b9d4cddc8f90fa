"""The registered queries of this subpackage, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailmart.llm import chat, langid, licenses, minhash, mixing, packing, pii, quality, search, segment, simhash, trie, warc
from retailmart.llm.follow import followed
from retailmart.llm.oracle import ORACLE  # noqa: F401
from retailmart.llm.text import filled
from retailmart.sources.scratch import removed_at_end, shared_folder, written

KEY = "demonstration key"  # a real run passes its own secret


TOKENIZERS = "/opt/tokenizers"


def vocabulary_file(folder: str = TOKENIZERS) -> bytes:
    """The piece vocabulary, half a megabyte; it travels to the tasks with their function."""
    with open(f"{folder}/piece_bpe_32k.model", "rb") as file:
        return file.read()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id bigint, turn bigint, role string, text string")
    return chat.read_chats(chat.format_chats(rows.unionByName(extra))).drop("state")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and how many others lie within three bits.

    ``n_within`` is for documents whose id is divisible by 100: the other distinct fingerprints near theirs.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", filled("text").alias("text"))
    pairs = followed(docs, "doc_id", ["doc_id", "text"])
    n, cut = F.char_length("text"), F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    # rows may repeat an id and a text: each is its own key; their order, and so the number, is the same in every attempt of a task
    pairs = pairs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "next_doc_id", n.cast("bigint").alias("n_chars"), "text", edited.alias("edited"))
    both = F.array(F.struct(F.lit(0).alias("side"), F.col("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))
    sides = pairs.select("row", "doc_id", "next_doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.explode(both).alias("s"))
    keys = ["row", "doc_id", "next_doc_id", "n_chars", "edited_sha256"]
    marked = simhash.fingerprints(sides.select(*keys, "s.side", "s.text"), [*keys, "side"])
    side = lambda i: F.max(F.when(F.col("side") == i, F.col("fingerprint")))
    prints = written(marked.groupBy(*keys).agg(side(0).alias("own"), side(1).alias("changed")), "prints")
    following = prints.groupBy(F.col("doc_id").alias("following")).agg(F.min("own").alias("after"))
    asked = prints.where("doc_id % 100 = 0").select(F.col("own").alias("fingerprint"))
    near = simhash.within(asked, prints.select(F.col("own").alias("fingerprint")))
    near = near.where("query <> found").groupBy(F.col("query").alias("asked")).agg(F.count("*").alias("n"))
    out = prints.join(following, prints.next_doc_id.eqNullSafe(following.following), "left")
    out = out.join(near, out.own == near.asked, "left")
    shown = lambda c: F.lpad(F.hex(c), 16, "0")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", shown("own").alias("fingerprint"), shown("changed").alias("edited_fingerprint"),
        simhash.likeness(F.col("own"), F.col("changed")).alias("near_edited"), simhash.likeness(F.col("own"), F.col("after")).alias("near_next"),
        F.when(F.col("doc_id") % 100 == 0, F.coalesce("n", F.lit(0))).alias("n_within"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms in its text, and the number of each kind found."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, KEY)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence identifiers and licenses of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "license_sentences", "licenses", "unmatched")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality.judge(docs).select("doc_id", *quality.MEASURES, "left_words", "kept")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = langid.train(docs.where(~held_out), "doc_id", "text", "lang")
    return langid.identify(docs, model).withColumn("held_out", held_out)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicates by two-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, shingle=2)


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of every document, the best whole, the others as edits of it; and what they decode to.

    ``n_chars`` and ``text_sha256`` are the text's own, made apart from the encoder.
    """
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.char_length(filled("text")).cast("bigint").alias("n_chars"), F.sha2(filled("text"), 256).alias("text_sha256"), "text"
    )
    found = segment.encode(docs, vocabulary_file(), read_back=True)
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "score", "ids", "others",
        "n_chars", "text_sha256", "decoded_chars", "decoded_sha256", "others_agree",
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC files and read back."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    removed_at_end(spark, folder)
    read = warc.read_archives(spark, folder)
    return read.select(F.col("id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix of all sources takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def byte_vocabulary(folder: str = TOKENIZERS) -> tuple[bytes, bytes]:
    """The byte-level vocabulary as ranks and its definition, two megabytes that travel to the tasks with their function."""
    with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as ranks, open(f"{folder}/byte_bpe_50k.json", "rb") as definition:
        return ranks.read(), definition.read()


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of at most 2048 tokens, packed into sequences."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.token_pieces(docs, *byte_vocabulary()))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return search.search(docs, items)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix tree of all conversations, each begun by the first turns of the one that its hundred starts with."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    placed = rows.where("conv_id is not null").withColumn("at", F.row_number().over(order) - 1)
    own = placed.where(F.col("at") >= borrowed).select("conv_id", "at", "role", "text")
    heads = placed.where("conv_id % 100 = 0 and at < 5").select(F.col("conv_id").alias("base"), "at", "role", "text")
    members = rows.where("conv_id is not null").select("conv_id").distinct()
    begun = members.withColumn("base", F.expr("conv_id - conv_id % 100")).join(heads, "base").where(F.col("at") < borrowed)
    rebuilt = own.unionByName(begun.select("conv_id", "at", "role", "text"))
    return trie.prefix_tree(rebuilt, members, turn="at").drop("node", "parent")


QUERIES = {
    "op1_chat": op1_chat,
    "op2_simhash": op2_simhash,
    "op3_pii": op3_pii,
    "op4_licenses": op4_licenses,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_minhash": op7_minhash,
    "op8_pieces": op8_pieces,
    "op9_warc": op9_warc,
    "op10_mixing": op10_mixing,
    "op11_packing": op11_packing,
    "op12_search": op12_search,
    "op13_trie": op13_trie,
}
