"""Deterministic sharded WARC files: written by range, rolled by compressed size, committed by manifest.

Records are range-sorted by key and compressed one gzip member each. A record's place is
the compressed size of all records before it: each partition sums its own, and partitions start at
the sum of the earlier ones (a table of one row per partition). The file of a record is its place
divided by the roll size, so files depend on the records alone, not on partitioning or on retries.
A file is written under a temporary name of its attempt and renamed when it is complete; the manifest,
written last, lists the files, and readers go by the manifest. A lost task leaves a
temporary file that nobody reads.

Of equal payloads, found by SHA-1 and length, the record with the smallest key is a response and the others
revisit it. Dates are a parameter; identifiers are made from keys; gzip headers carry no time.

Defined results: NULL payload is empty; repeated rows are records of their own, of which those that hold the
smallest key are responses; a row without key is written last and never the response of
others; an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailmart.sources.scratch import written

ROLL = 32 << 20  # compressed bytes after which a new file begins
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
_ID = "urn:x-page:"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(lines: list[tuple[str, str]], block: bytes) -> bytes:
    text = "".join(f"{k}: {v}\r\n" for k, v in [*lines, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{text}\r\n".encode() + block + b"\r\n\r\n"


def record(key, url: str | None, payload: bytes, payload_digest: str, refers_to, date: str) -> bytes:
    """One response or revisit record, one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    kind = "response" if refers_to is None else "revisit"
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{_ID}{key}>"), ("WARC-Date", date)]
    lines += [("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%"))] if url else []
    lines += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if refers_to is not None:
        lines += [("WARC-Refers-To", f"<{_ID}{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return gzip.compress(_header(lines, block), LEVEL, mtime=0)


def _members(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    """Compressed records with their place within the partition; ahead of a key's records come its references."""
    part, place, now, first = TaskContext.get().partitionId(), 0, None, {}
    for batch in batches:
        rows = []
        for key, sha, low, url, html, is_record in zip(*batch.columns, strict=True):
            key, sha, low = key.as_py(), sha.as_py(), low.as_py()
            if key != now:
                now, first = key, {}
            if not is_record.as_py():
                first[sha] = low
                continue
            payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
            name = base64.b32encode(bytes.fromhex(sha)).decode()
            member = record("" if key is None else key, url.as_py(), payload, name, first.get(sha), date)
            rows.append((part, place, member))
            place += len(member)
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.binary()], strict=True)], ["part", "place", "member"])


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")


def _files(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    """Writes each file as its records come, sorted by file and place; one manifest row per file."""
    store, base = _filesystem(folder)
    store.create_dir(base, recursive=True)
    attempt, out, now, rows = uuid.uuid4().hex, None, None, []

    def close() -> None:
        out.close()
        name = f"part-{now:08d}.warc.gz"
        store.move(f"{base}/_{name}.{attempt}", f"{base}/{name}")
        rows.append((f"{folder}/{name}", now, count, size, sha.hexdigest()))

    for batch in batches:
        for number, member in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if number != now:
                if out is not None:
                    close()
                now, count, size, sha = number, 0, 0, hashlib.sha256()
                out = store.open_output_stream(f"{base}/_part-{now:08d}.warc.gz.{attempt}", compression=None)
                info = f"software: retailmart\r\nformat: WARC File Format 1.1\r\nisPartOf: part-{now:08d}\r\n".encode()
                lines = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-file:{now}>"), ("WARC-Date", date), ("WARC-Filename", f"part-{now:08d}.warc.gz"), ("Content-Type", "application/warc-fields")]
                first = gzip.compress(_header(lines, info), LEVEL, mtime=0)
                out.write(first)
                sha.update(first)
                size += len(first)
            out.write(member)
            sha.update(member)
            count, size = count + 1, size + len(member)
    if out is not None:
        close()
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "number", "records", "bytes", "sha256"])


def write_archives(
    df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, roll: int = ROLL, date: str = DATE
) -> DataFrame:
    """Write all rows as WARC files in ``folder``; the manifest, one row per file, is returned and stored beside them.

    Payloads of fewer than ``least`` bytes are always responses. Payloads move once, in the range sort;
    references to earlier equal payloads are sorted in among them instead of being joined.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = df.select(F.col(key).alias("key"), F.sha1(text.cast("binary")).alias("sha"), F.octet_length(text).alias("size"), F.col(url).cast("string").alias("url"), text.alias("text"))
    named = rows.select("key", "sha", "size")
    lowest = named.where(F.col("size") >= least).groupBy("sha", "size").agg(F.min("key").alias("low"), F.count("*").alias("n")).where("n > 1")
    again = named.join(lowest, ["sha", "size"]).where((F.col("low") < F.col("key")) | (F.col("key").isNull() & F.col("low").isNotNull()))
    again = again.select("key", "sha", "low", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("text"), F.lit(False).alias("is_record"))
    records = rows.select("key", "sha", F.lit(None).cast(df.schema[key].dataType).alias("low"), "url", "text", F.lit(True).alias("is_record"))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("key").asc_nulls_last(), F.col("is_record"), F.col("url").asc_nulls_first(), F.col("sha")]
    sorted_rows = records.unionByName(written(again, "again")).repartitionByRange(parts, order[0]).sortWithinPartitions(*order)
    members = written(sorted_rows.mapInArrow(partial(_members, date=date), "part bigint, place bigint, member binary"), "members")

    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = members.groupBy("part").agg(F.sum(F.length("member")).alias("bytes"))
    starts = written(ends.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")), "starts")
    number = F.floor((F.col("start") + F.col("place")) / F.lit(roll)).cast("bigint")
    dealt = members.join(starts, "part").select(number.alias("number"), "part", "place", "member")
    # ranges of numbers, as many as there are files: hashes would put several files in one task
    files = max(1, -(-(ends.agg(F.sum("bytes")).first()[0] or 0) // roll))
    dealt = dealt.repartitionByRange(files, "number").sortWithinPartitions("number", "part", "place").select("number", "member")
    made = dealt.mapInArrow(partial(_files, folder=folder, date=date), "file string, number bigint, records bigint, bytes bigint, sha256 string")
    made.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _streamed(source, size: int = 1 << 16) -> Iterator[bytes]:
    """The uncompressed bytes of a file, one gzip member at a time; a member holds one record."""
    rest, inflate, out = b"", zlib.decompressobj(31), io.BytesIO()
    while True:
        data = rest or source.read(size)
        if not data:
            break
        out.write(inflate.decompress(data))
        rest = inflate.unused_data
        if inflate.eof:
            yield out.getvalue()
            inflate, out = zlib.decompressobj(31), io.BytesIO()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, base = _filesystem(path)
            rows, held = [], 0
            with store.open_input_stream(base, compression=None) as source:
                for raw in _streamed(source):
                    head, _, block = raw.partition(b"\r\n\r\n")
                    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    block = block[: int(fields["Content-Length"])]
                    http, _, payload = block.partition(b"\r\n\r\n")
                    full = int(http.decode().rpartition("Content-Length: ")[2])
                    name = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if digest(block) != fields["WARC-Block-Digest"].removeprefix("sha1:") or fields["WARC-Type"] == "response" and digest(payload) != name:
                        raise ValueError(f"{path}: record {fields['WARC-Record-ID']} does not have its digest")
                    number, other = (fields.get(x, "")[1 + len(_ID) : -1] or None for x in ("WARC-Record-ID", "WARC-Refers-To"))
                    rows.append((number, fields.get("WARC-Target-URI"), fields["WARC-Type"], name, full, other, payload.decode("utf-8", "surrogatepass") if fields["WARC-Type"] == "response" else None))
                    held += full
                    if held > 8 << 20 or len(rows) >= 5000:
                        yield out(rows)
                        rows, held = [], 0
            if rows:
                yield out(rows)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the files in the manifest: id, url, type, digest and size of the full payload, what it refers to, payload.

    Digests are checked. The payload of a revisit is NULL; its response has it.
    """
    manifest = spark.read.parquet(f"{folder}/manifest").select("file", "number")
    # a given number of partitions stays as it is: one for each file
    files = manifest.repartitionByRange(max(1, manifest.count()), "number").select("file")
    return files.mapInArrow(_records, "id string, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to string, payload string")
