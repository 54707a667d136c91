"""WARC writer and reader: range-sorted records, files rolled by compressed size.

Records are sorted by page id over range partitions. Each partition streams its rows into gzip
files, one member per record, and starts the next file when the compressed size reaches the limit.
Headers, record ids and digests are made anew from the content, so a rerun gives the same bytes.
Equal payloads are found on digests before; a small marker row per revisit travels with the pages
through the one wide shuffle.
"""

import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import store
from fareline.llm.files import Committed, open_store, shard_count
from fareline.session import scratch

ROLL_BYTES = 64 << 20
LEAST_PAYLOAD = 100
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("5f1d0f0e-2a56-5f0b-9c53-3c1a8f3c8f11")


def record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}:{digest}:{copy}')}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    headers = [*headers, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def page_record(page_id: int | None, url: str | None, payload: bytes, copy: int, refers_to: int | None, date: str = DATE) -> bytes:
    """A response record, or a revisit record without payload if refers_to is given."""
    digest = hashlib.sha256(payload).hexdigest()
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest, copy)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url)))
    if page_id is not None:
        headers.append(("WARC-Page-ID", str(page_id)))
    headers += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return _record(headers, http + payload)
    return _record([*headers, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Refers-To-Page-ID", str(refers_to))], http)


def write_warc(pages: DataFrame, uri: str, roll_bytes: int = ROLL_BYTES, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Write `pages` (page_id, url, html) below the folder `uri`; returns the manifest (name,
    records, bytes), which is also stored at `uri`/manifest and lists the committed files.

    One record per row; null html is an empty payload, null url has no target header. Among equal
    payloads of at least `least` bytes the smallest page_id is the response. A null page_id sorts
    first and is a response unless a row with an id has its payload. Repeated rows: the first is the
    response, the others revisit it."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    narrow, _ = store(src.select("page_id", "digest", F.octet_length("html").alias("size")), "op4-digests")
    firsts, _ = store(narrow.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1 and first is not null").drop("c"), "op4-firsts")
    marks = narrow.where(F.col("size") >= least).join(firsts, "digest").where("page_id is null or page_id > first").select("page_id", "digest", "first").distinct()
    null = lambda t: F.lit(None).cast(t)
    rows = src.select("page_id", "digest", F.lit(1).alias("kind"), "url", "html", null("long").alias("first")).union(marks.select("page_id", "digest", F.lit(0), null("string"), null("string"), "first"))
    total = narrow.agg(F.sum("size")).head()[0] or 0
    shards = shard_count(int(total), spark.sparkContext.defaultParallelism)
    key = [F.col("page_id").asc_nulls_first(), "digest"]

    def run(batches):
        from pyspark import TaskContext

        shard, seq, out, records, done = TaskContext.get().partitionId(), 0, None, 0, []
        mark, last, copy = None, None, 0

        def close():
            nonlocal out, records, seq
            if out is not None:
                out.commit()
                done.append((out.name, records, out.size))
                out, records, seq = None, 0, seq + 1

        for batch in batches:
            for page_id, digest, kind, url, text, first in zip(*(c.to_pylist() for c in batch.columns)):
                if (page_id, digest) != last:
                    mark, last, copy = None, (page_id, digest), 0
                if kind == 0:
                    mark = first
                    continue
                payload = text.encode("utf-8", "surrogatepass")
                refers = mark if mark is not None else page_id if copy and len(payload) >= least else None
                if out is None:
                    out = Committed(uri, f"part-{shard:06d}-{seq:05d}.warc.gz")
                    out.write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, out.name)), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                out.write(page_record(page_id, url, payload, copy, refers))
                records, copy = records + 1, copy + 1
                if out.size >= roll_bytes:
                    close()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["name", "records", "bytes"])

    sorted_ = rows.repartitionByRange(shards, *key).sortWithinPartitions(*key, "kind", "url")
    sorted_.mapInArrow(run, "name string, records long, bytes long").write.parquet(f"{uri}/manifest")
    return spark.read.schema("name string, records long, bytes long").parquet(f"{uri}/manifest")


def records(uri: str, name: str):
    """Header dict and block of each record of a file; one record is held at a time."""
    fs, root = open_store(uri)
    with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
        unzip, data, rest = zlib.decompressobj(31), bytearray(), f.read(1 << 20)
        while rest:
            data += unzip.decompress(rest)
            if unzip.eof:
                head, _, body = bytes(data).partition(b"\r\n\r\n")
                headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                block = body[: int(headers["Content-Length"])]
                if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}" or body[len(block) :] != b"\r\n\r\n":
                    raise ValueError(f"{name}: damaged record {headers['WARC-Record-ID']}")
                yield headers, block
                rest, unzip, data = unzip.unused_data, zlib.decompressobj(31), bytearray()
                rest = rest or f.read(1 << 20)
            else:
                rest = f.read(1 << 20)
        if data:
            raise ValueError(f"{name}: ends within a record")


def read_warc(manifest: DataFrame, uri: str, payload: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to[, url, payload]) per record of
    the manifest's files. Every block digest is checked; a response's payload digest is made anew."""

    def run(batches):
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows = []
                for h, block in records(uri, name):
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    http, _, body = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                    if h["WARC-Type"] == "response" and (size != len(body) or digest != hashlib.sha256(body).hexdigest()):
                        raise ValueError(f"{name}: payload of {h['WARC-Record-ID']} differs from its digest")
                    ids = [int(h[k]) if k in h else None for k in ("WARC-Page-ID", "WARC-Refers-To-Page-ID")]
                    rows.append((ids[0], size, digest, h["WARC-Type"], ids[1], *([h.get("WARC-Target-URI"), body] if payload else [])))
                    if len(rows) == (64 if payload else 4096):
                        yield table(rows)
                        rows = []
                if rows:
                    yield table(rows)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    wide = 7 if payload else 5

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds[:wide])], names[:wide])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", url string, payload binary" if payload else "")
    files = max(1, min(manifest.count(), 8 * manifest.sparkSession.sparkContext.defaultParallelism))
    return manifest.repartition(files).mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    uri = scratch(pages.sparkSession, "op4-warc")
    return read_warc(write_warc(pages, uri), uri)
