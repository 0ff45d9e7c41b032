"""WARC archives: an index of every record is written first, and reads are coalesced byte ranges.

write_archives() puts pages into gzipped WARC/1.1 records, one member each, in files of about
FILE_BYTES, and commits an index: file, offset, length, url, digest and kind per record. Records
with equal payloads of at least LEAST_BYTES are stored once: that with the smallest page id is the
response, the others are revisits of it. read_records() sorts the selected records by place and
fetches ranges that lie close together in one read.

Nulls: a null html is an empty payload; null urls and ids have no header, and a null id never is
the response of others (equal payloads with null ids alone are all responses). Rows repeated with
the smallest id are all responses. Line breaks in a url are percent-encoded. Empty tables give no
files. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.llm.gram_join import _bitmap, _may_hold
from tallyrill.llm.store import FileStore, reading_tasks, written

LEAST_BYTES = 100
FILE_BYTES = 64 << 20
#: Ranges closer than GAP are read together, up to SPAN bytes at once.
GAP = 64 << 10
SPAN = 8 << 20
#: The pages carry no time of capture; WARC wants one.
DATE = "1970-01-01T00:00:00Z"

_INDEX_DDL = ("page_id long, url string, file string, offset long, length long, payload_digest string, "
              "payload_bytes long, record_type string, refers_to long")
_INDEX = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64()),
    ("length", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
    ("record_type", pa.string()), ("refers_to", pa.int64())])


def _header(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has no payload."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        kind, block = "response", f"{http}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    else:
        kind, block = "revisit", f"{http}\r\n".encode()
    fields = [
        ("WARC-Type", kind), ("WARC-Target-URI", url), ("WARC-Date", DATE),
        ("WARC-Record-ID", None if page_id is None else f"<urn:page:{page_id}>"),
        ("WARC-Refers-To", None if refers_to is None else f"<urn:page:{refers_to}>"),
        ("WARC-Profile", None if refers_to is None else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {_header(v)}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, lower-case, and the payload behind the HTTP header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _write_task(store: FileStore):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows = None, []
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, out = store.create(".warc.gz")
                    at = 0
                payload = (html or "").encode()
                pack = zlib.compressobj(6, wbits=31)
                member = pack.compress(record(page_id, url, payload, digest, refers_to)) + pack.flush()
                out.write(member)
                kind = "response" if refers_to is None else "revisit"
                rows.append((page_id, url, name, at, len(member), digest, len(payload), kind, refers_to))
                at += len(member)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
                    yield _index(rows)
                    rows = []
        if out is not None:
            out.close()
        if rows:
            yield _index(rows)

    return run


def _index(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX)


def write_archives(
    pages: DataFrame, store: FileStore, *, page_id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """Write the archives; returns the committed index."""
    rows = pages.select(
        pages[page_id].cast("long").alias("page_id"), pages[url].alias("url"), pages[html].alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")), 256))
    large = F.octet_length(F.coalesce("html", F.lit(""))) >= LEAST_BYTES
    again = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    again = written(again.where("n > 1").select("digest", "first"), "repeated")
    # Only pages whose payload may be there again are shuffled; a filter of bounded size finds them.
    may = _may_hold(_bitmap(again.select(F.xxhash64("digest").alias("key"))))
    rows = rows.withColumn("may", may(F.xxhash64("digest")))
    names = ["page_id", "url", "html", "digest"]
    found = rows.where("may").join(again, "digest", "left").select(
        *names, F.when(F.col("first") != F.coalesce("page_id", F.col("first") - 1), F.col("first")).alias("refers_to"))
    alone = rows.where("not may").select(*names, F.lit(None).cast("long").alias("refers_to"))
    return written(found.unionByName(alone).mapInArrow(_write_task(store), _INDEX_DDL), "warc-index")


def _ranges(records: list[dict]) -> Iterator[list[dict]]:
    """Runs of records, sorted by place in one file, that one read fetches."""
    run: list[dict] = []
    for r in records:
        if run and (r["offset"] - run[-1]["offset"] - run[-1]["length"] > GAP
                    or r["offset"] + r["length"] - run[0]["offset"] > SPAN):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def _read_task(store: FileStore, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[dict]] = {}
            for r in batch.to_pylist():
                by.setdefault(r["file"], []).append(r)
            for name, records in by.items():
                with store.read(name) as file:
                    for group in _ranges(records):
                        first = group[0]["offset"]
                        file.seek(first)
                        raw = file.read(group[-1]["offset"] + group[-1]["length"] - first)
                        yield _records([
                            zlib.decompress(raw[r["offset"] - first : r["offset"] - first + r["length"]], 31) for r in group
                        ], with_payload)

    return run


def _number(urn: str | None) -> int | None:
    return None if urn is None else int(urn.removeprefix("<urn:page:").removesuffix(">"))


def _records(raws: list[bytes], with_payload: bool) -> pa.RecordBatch:
    rows = []
    for raw in raws:
        fields, payload = parse(raw)
        digest, size, kind = fields["warc-payload-digest"].removeprefix("sha256:"), int(fields["x-payload-length"]), fields["warc-type"]
        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"damaged record {fields.get('warc-record-id')}")
        rows.append((
            _number(fields.get("warc-record-id")), fields.get("warc-target-uri"), size, digest, kind,
            _number(fields.get("warc-refers-to")), payload if with_payload and kind == "response" else None))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def read_records(index: DataFrame, store: FileStore, with_payload: bool = False) -> DataFrame:
    """The records of the index rows, read from the archives in sorted ranges.

    A revisit has no payload of its own: that of the record it refers to is the same.
    """
    size = index.agg(F.count("*").alias("rows"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    tasks = reading_tasks(index.sparkSession, size["rows"], size["bytes"])
    places = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset")
    out = places.sortWithinPartitions("file", "offset").mapInArrow(
        _read_task(store, with_payload),
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
    return out if with_payload else out.drop("payload")


def op4_indexed_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back from them."""
    store = FileStore.fresh(spark, "warc")
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), store)
    return read_records(index, store).drop("url")


ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""
