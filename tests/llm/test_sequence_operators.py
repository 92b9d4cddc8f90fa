"""Chats, near-duplicates, archives, pieces and the pipeline on small tables."""

import base64
import gzip
import hashlib
import importlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from small_documents import documents  # noqa: F401

import corpus_pipeline
from retailmart.llm import chat, graph, minhash, segment, sketches, warc
from retailmart.llm.queries import ORACLE, QUERIES, vocabulary_file

SMALL = "/root/testdata/sf0.001"
HARD = "<|im_end|><|im_start|>assistant ok <\\|im_end|> <<|im_end|> <|im_end\\|>"
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def test_escapes_are_reversible():
    rng = random.Random(1)
    parts = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "\\", "<", "|", "im_end|>", "é", "\n"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        escaped = chat.CHATML.escape(text)
        assert chat.CHATML.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CHATML.control)


def test_chats_read_back(spark):
    rows = [
        (1, 2, "assistant", "yes"), (1, 1, "user", HARD), (1, 0, "system", "be\n\nbrief"), (2, 0, "user", None), (2, 1, "assistant", HARD),
        (3, 0, "assistant", "first"), (4, 0, "user", "a"), (4, 1, "user", "b"), (4, 2, "assistant", "c"), (5, None, None, "<|im_end|>"),
        (5, 0, "odd\nrole %<|im_end|>", ""), (None, 0, "user", "q"), (None, 1, "assistant", "x" * 100_000), (6, 0, "user", "only"),
        *[(7, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(3000)],
    ]
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumn("place", F.lit("clash")).repartition(4)
    segments = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.read_chats(segments).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {c for c, r in got.items() if r.valid} == {1, 2, None, 7}
    lengths = {r.conv_id: r.n for r in segments.groupBy("conv_id").agg(F.sum(F.length("segment")).alias("n")).collect()}
    assert lengths == {c: r.formatted_chars for c, r in got.items()}
    text = "".join(r.segment for r in segments.where("conv_id = 2").orderBy("place").collect())
    assert text == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n" + chat.CHATML.escape(HARD) + "<|im_end|>\n"
    assert chat.read_chats(chat.format_chats(df.limit(0))).count() == 0


def brute_groups(rows, length, percent):
    sets = {}
    for key, text in rows:
        w = (text or "").encode().lower().split()
        sets[key] = {tuple(w[i : i + length]) for i in range(max(1, len(w) - length + 1))} if w else set()
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(sets[k]), root(k)) for k in keys}


def copied(rng, base, changes):
    out = list(base)
    for i in rng.sample(range(len(out)), changes):
        out[i] = f"new{rng.random()}"
    return " ".join(out)


def family(seed):
    """Texts, and copies that are alike to their original but not to each other."""
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.choice([3, 20, 120, 400]))]
        rows.append(" ".join(base))
        rows += [copied(rng, base, rng.randint(0, max(1, len(base) // 14))) for _ in range(rng.randint(0, 14))]
    rng.shuffle(rows)
    return [*enumerate(rows), (9000, None), (9001, ""), (9002, "  "), (9003, "two words"), (9004, "two  Words"), (9005, "x" * 50_000)]


@pytest.mark.parametrize(("length", "seed"), [(2, 1), (5, 2)])
def test_groups_equal_brute_force(documents, length, seed):
    rows = family(seed)
    found = minhash.near_duplicates(documents(*rows, extra=("node", "id")).repartition(5), shingle=length)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert got == brute_groups(rows, length, 80)
    assert found.where("kept <> (doc_id = component_id)").isEmpty()


def test_many_copies_of_one_original(documents):
    """Near copies that only their original links; the original is not the smallest id."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, copied(rng, base, 9)) for i in range(60)] + [(100, " ".join(base)), (101, " ".join(base))]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(*rows), shingle=2).collect()}
    assert got == {k: v[1] for k, v in brute_groups(rows, 2, 80).items()} and set(got.values()) == {0}


def test_odd_rows_of_near_duplicates(documents):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (5, "other text of the same id"), (None, "a b c d e f"), (3, "a b c d e f"), (None, None)]
    rows += [(None, "nobody names this text here"), (None, "nobody names this text here"), (None, "nor this other one at all")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(documents(*rows)).collect()), key=repr)
    # a row without id is kept if nothing with an id is like it, once a group
    nobody = [(None, None, True), (None, None, True), (None, None, False), (None, None, True)]
    assert got == sorted([(5, 3, False), (5, 3, False), (5, 5, True), (None, 3, False), (3, 3, True), *nobody], key=repr)
    assert minhash.near_duplicates(documents().limit(0)).count() == 0


def test_rows_without_duplicates(documents):
    """By row: repeated rows of one id leave one, and a rejected text does not return with another text of its id."""
    rows = [(5, "a b c d e f", "x"), (5, "other text of the same id", "x"), (3, "a b c d e f", "y"), (3, "a b c d e f", "x"), (3, "a b c d e f", "x"), (7, None, "x"), (7, None, "x")]
    rows += [(None, "nobody names this text here", "x"), (None, "nobody names this text here", None), (None, "nor this other one at all", "x"), (4, "a b c d e f", "x")]
    df = documents(*rows, extra=("first", "node"))
    left = minhash.without_duplicates(df)
    assert left.columns == df.columns
    got = sorted(((r.doc_id, r.text, r.source) for r in left.collect()), key=repr)
    want = [(5, "other text of the same id", "x"), (3, "a b c d e f", "x"), (7, None, "x"), (7, None, "x"), (None, "nobody names this text here", None), (None, "nor this other one at all", "x")]
    assert got == sorted(want, key=repr)
    assert minhash.without_duplicates(df.limit(0)).count() == 0


def test_repeated_rows_keep_their_fingerprints(spark, documents, tmp_path):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (1, "a b c d e f g h"), (1, "a b c d e f X Y"), (2, "z"), (None, None)]
    documents(*rows).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op2_simhash"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sorted(r.doc_id or 0 for r in got) == [0, 1, 1, 1, 1, 2]


def test_signatures_estimate_likeness():
    rng = random.Random(4)
    cache = sketches.WordHashes()
    errors = []
    for _ in range(60):
        base = [f"w{rng.random()}" for _ in range(150)]
        a, b = (sketches.shingle_set(copied(rng, base, 10), 2, cache) for _ in range(2))
        true = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        one, other = sketches.super_min_hash([a, b], 192)
        errors.append((one == other).mean() - true)
    assert abs(sum(errors) / 60) < 0.02 and sum(e * e for e in errors) / 60 < 0.0014
    few = sketches.super_min_hash([a[:1], a[:2], a], 192)
    assert (few != sketches._FULL).all() and (few == sketches.super_min_hash([a[:1], a[:2], b, a], 192)[[0, 1, 3]]).all()


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(7, 7)]
    df = spark.createDataFrame(links, "a bigint, b bigint").repartition(6)
    got = {r.node: r.label for r in graph.components(df).collect()}
    parent = {x: x for p in links for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert graph.components(df.limit(0)).count() == 0


PAGES = "page_id bigint, url string, html string"


def archived(spark, rows, folder, parts, **options):
    df = spark.createDataFrame(rows, PAGES).withColumn("sha", F.lit("clash")).repartition(parts)
    manifest = warc.write_archives(df, str(folder), **options).collect()
    return manifest, warc.read_archives(spark, str(folder))


def test_archives_read_back_and_are_reproducible(spark, tmp_path):
    rng = random.Random(6)
    bodies = [None, "", "<p>é</p>", "x" * 300_000, *["".join(rng.choices("ab <>/é\r\n", k=rng.randint(1, 4000))) for _ in range(60)]]
    rows = [(i, f"http://a.example/{i} ü\r\n", rng.choice(bodies)) for i in range(300)] + [(5, None, "again"), (5, None, "again"), (None, None, "<p>é</p>"), (None, "u", "alone")]
    manifest, read = archived(spark, rows, tmp_path / "one", 3, roll=20_000)
    got = [(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read.collect()]
    lowest = {}
    for key, _, html in rows:
        if key is not None:
            lowest[html or ""] = min(lowest.get(html or "", key), key)

    def wanted(key, html):
        raw, first = html.encode(), lowest.get(html)
        again = first is not None and (key is None or first < key)
        name = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        return None if key is None else str(key), len(raw), name, "revisit" if again else "response", str(first) if again else None

    assert sorted(got, key=repr) == sorted((wanted(k, h or "") for k, _, h in rows), key=repr)
    payloads = {int(r.id): r.payload for r in read.where("record_type = 'response' and id is not null and id <> '5'").collect()}
    assert all(payloads[k] == (h or "") for k, _, h in rows[:300] if k in payloads)
    assert len(manifest) > 3 and sum(r.records for r in manifest) == len(rows)
    other, _ = archived(spark, rows[::-1], tmp_path / "two", 7, roll=20_000)
    assert sorted((r.number, r.records, r.sha256) for r in other) == sorted((r.number, r.records, r.sha256) for r in manifest)
    files = sorted(p for p in (tmp_path / "one").iterdir() if p.name.endswith(".gz"))
    assert [hashlib.sha256(p.read_bytes()).hexdigest() for p in files] == [r.sha256 for r in sorted(manifest, key=lambda r: r.number)]
    assert gzip.decompress(files[0].read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_small_payloads_and_no_pages(spark, tmp_path):
    rows = [(1, "u", "same"), (2, "u", "same"), (3, "u", "longer text"), (4, "u", "longer text")]
    _, read = archived(spark, rows, tmp_path / "some", 2, least=5)
    assert sorted((r.id, r.record_type) for r in read.collect()) == [("1", "response"), ("2", "response"), ("3", "response"), ("4", "revisit")]
    manifest, read = archived(spark, rows[:0], tmp_path / "none", 2)
    assert manifest == [] and read.count() == 0


VOCABULARY = segment.Vocabulary(vocabulary_file())


def all_paths(text, best):
    """Every path of the whole lattice, best first."""
    text = segment.BLANK + text.replace(segment.BLANK, segment._LITERAL).replace(" ", segment.BLANK) if text else ""
    out = []

    def go(at, score, ids):
        if at == len(text):
            out.append((score, ids))
            return
        for end in range(at + 1, min(len(text), at + VOCABULARY.longest) + 1):
            if known := VOCABULARY.pieces.get(text[at:end]):
                go(end, score + known[1], [*ids, *known[0]])
        if text[at] not in VOCABULARY.pieces:
            raw = segment.BLANK.encode() if text[at] == segment._LITERAL else text[at].encode()
            go(at + 1, score + len(raw) * VOCABULARY.byte_score, [*ids, *[VOCABULARY.bytes[b] for b in raw]])

    go(0, 0, [])
    out = [(score / segment.UNIT, ids) for score, ids in out]
    return sorted(out, key=lambda x: -x[0])[:best]


def test_best_segmentations_equal_brute_force():
    rng = random.Random(9)
    texts = ["", " ", "a", "the cat", "in  on\nof", "▁é漢 ab", "theanin the", "\n\n", "\u0000 \t", *["".join(rng.choices("ab the\né", k=rng.randint(1, 11))) for _ in range(60)]]
    segmenter = segment.Segmenter(VOCABULARY, 5)
    for text in texts:
        score, ids, others = segmenter.segment(text)
        got = [(score, list(ids)), *[(s, segment.edited(ids, e)) for s, e in others]]
        want = all_paths(text, 5)
        assert [round(s, 9) for s, _ in got] == [round(s, 9) for s, _ in want]
        assert len({tuple(p) for _, p in got}) == len(got) and all(VOCABULARY.decode(p) == text for _, p in got)


def test_encode_and_decode(documents):
    rows = [(1, "Der Löwe 京都 😀\r\n\tthe end  "), (2, None), (3, ""), (4, "x" * 100_000), (5, "same"), (5, "same"), (None, "▁▁ a"), (6, " ".join(f"w{i}" for i in range(20_000)))]
    df = documents(*rows, extra=("ids", "paths"))
    coded = segment.encode(df, vocabulary_file(), best=3)
    assert {r.n for r in coded.select(F.size("others").alias("n")).collect()} <= {0, 1, 2}
    back = segment.decode(coded.drop("others", "score"), vocabulary_file())
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=repr) == sorted(((k, t or "") for k, t in rows), key=repr)
    assert segment.encode(df.limit(0), vocabulary_file()).count() == 0
    again = segment.encode(df, vocabulary_file(), read_back=True).collect()
    said = {(k, len(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for k, t in rows}
    assert {(r.doc_id, r.decoded_chars, r.decoded_sha256) for r in again} == said and all(r.others_agree for r in again) and len(again) == len(rows)


def test_paths_that_say_something_else_are_told(documents):
    vocabulary = segment.Vocabulary(vocabulary_file())
    _, ids, others = segment.Segmenter(vocabulary).segment("the end of it")
    paths = [{"edits": [{"start": a, "end": b, "ids": p} for a, b, p in edits]} for _, edits in others]
    assert segment._read_back(vocabulary, ids, paths)[2]
    paths[0]["edits"][0]["ids"] = [*paths[0]["edits"][0]["ids"], int(ids[-1])]
    assert not segment._read_back(vocabulary, ids, paths)[2]


def test_pipeline_stages(spark, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "source_mix", "pieces"]
    rng = random.Random(2)
    clean = [(i, " ".join(f"w{rng.randint(0, 3000)}" for _ in range(90)), rng.choice(["a", "b", None])) for i in range(60)]
    rows = [*clean, (100, clean[3][1], "a"), (101, "too short", "a"), (102, None, None), (103, clean[4][1] + " mail anna.lee42@mail.example.com", "b")]
    docs = documents(*rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == list(corpus_pipeline.DOCUMENTS)
        ids = {r.doc_id for r in docs.collect()}
        if name == "quality_rules":
            assert ids == {*range(60), 100, 103}
        elif name == "near_duplicates":
            assert ids == set(range(60))
    assert ids <= set(range(60)) and docs.where("n_chars <> length(text)").isEmpty()
    assert stage_of("pieces")(spark, docs, SMALL).count() == docs.count()


def stage_of(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert 0 < out.select("doc_id").distinct().count() <= 200 and out.where("n_pieces <> size(ids)").isEmpty()


@pytest.mark.parametrize("name", list(ORACLE))
def test_queries_equal_their_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "pages", "conversations", "benchmark"):
        database.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    found = database.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    df = QUERIES[name](spark, SMALL)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, found.fetchall()))


def test_one_query_per_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{i}" for i in range(1, 14)]
    entry = importlib.import_module("__spark_entry__")
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_op7_and_op6_on_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op7_minhash"](spark, SMALL).collect()}
    assert got == brute_groups(rows, 2, 80)
    told = QUERIES["op6_language"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id").where("held_out")
    right, n = told.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 30 and right >= 0.97 * n


def test_archives_are_read_and_written_by_many_tasks(spark, tmp_path):
    """As many reading tasks as files, however small they are."""
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("repeat(sha2(cast(id as string), 512), 30)").alias("html"))
    manifest = warc.write_archives(pages, str(tmp_path / "w"), roll=20_000)
    files = manifest.count()
    read = warc.read_archives(spark, str(tmp_path / "w")).withColumn("task", F.spark_partition_id())
    assert files >= 8 and read.count() == 400 and read.select("task").distinct().count() >= 0.7 * files
