"""WARC archives with a two-level capture index.

Writing: each task streams its rows into gzip-per-record ``.warc.gz`` files in
the shared folder and returns one capture row per record (place, key). Payloads
of at least ``MIN_REVISIT`` bytes that are equal are stored once, in the record
of the smallest id; the others become ``revisit`` records.

Index: captures are range-partitioned by key (reversed host, path, id) and
sorted; a task writes its range as gzip blocks of ``BLOCK`` lines and a sparse
directory, the first key and place of each block. One row per index file, its
first key, is all the driver sees.

Lookup: a query key finds its index file among the first keys, its block by
binary search in that file's directory, its line by binary search in the one
block read, and its record by one ranged read. Queries are dealt by index file
and sorted, so neighbours share a block.

A task that fails leaves files no returned row names; a repeated task writes
new ones. Files go through pyarrow's file systems, by the scheme of
``spark.checkpoint.dir``.

Defined cases: a null payload is empty; a null url has an empty host and path; a
null id is written without a number and never referred to unless alone; rows
with equal ids and payloads are all responses; an empty table gives no files and
no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import shared_folder, ship, stored, table

MIN_REVISIT = 100
BLOCK = 1000             # index lines in a block
FILE_BYTES = 1 << 30     # an archive file is closed above this size
DATE = "2020-01-01T00:00:00Z"
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def url_key(url: Column) -> Column:
    """Sort key of a url: host labels in reverse, then path and query; no white space, no fragment."""
    u = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "%20")
    start = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)"
    host = F.lower(F.regexp_extract(u, start, 1))
    rest = F.regexp_replace(F.regexp_replace(u, start, ""), r"#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def capture_key(url: Column, page_id: Column) -> Column:
    return F.concat(url_key(url), F.lit(" "), F.coalesce(F.lpad(page_id.cast("string"), 20, "0"), F.lit("")))


def _urn(page_id: int | None) -> bytes:
    return b"<urn:x-page:%s>" % (b"" if page_id is None else b"%d" % page_id)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, not yet compressed."""
    kind = b"response" if refers_to is None else b"revisit"
    target = re.sub(r"[\x00-\x20\x7f]", "%20", url or "").encode("utf-8", "surrogatepass")
    block = _HEAD % len(payload) + (payload if refers_to is None else b"")
    lines = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: " + _urn(page_id), b"WARC-Date: " + DATE.encode(),
             b"WARC-Target-URI: " + target, b"WARC-Payload-Digest: sha256:" + digest.encode()]
    if refers_to is not None:
        lines += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  b"WARC-Refers-To: " + _urn(refers_to)]
    lines += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block), b"", b""]
    return b"\r\n".join(lines) + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of a decompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
    block = rest[: int(fields[b"Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = lambda f: int(m[1]) if (m := re.search(rb"urn:x-page:(-?\d+)", fields.get(f, b""))) else None
    revisit = fields[b"WARC-Type"] == b"revisit"
    stated = fields[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode()
    return {
        "page_id": number(b"WARC-Record-ID"), "url": fields[b"WARC-Target-URI"].decode("utf-8", "replace"), "payload": payload,
        "payload_bytes": size if revisit else len(payload),
        "payload_digest": stated if revisit else hashlib.sha256(payload).hexdigest(),
        "record_type": "revisit" if revisit else "response", "refers_to": number(b"WARC-Refers-To"), "stated": stated}


class _Files:
    """Open files of a task for ranged reads; the oldest is closed beyond 32."""

    def __init__(self) -> None:
        self.open: OrderedDict[str, object] = OrderedDict()

    def read(self, path: str, offset: int, length: int) -> bytes:
        f = self.open.pop(path, None)
        if f is None:
            store, at = _store(path)
            f = store.open_input_file(at)
            if len(self.open) >= 32:
                self.open.popitem(last=False)[1].close()
        self.open[path] = f
        return f.read_at(length, offset)

    def close(self) -> None:
        for f in self.open.values():
            f.close()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """``(page_id, url, html)`` -> capture rows ``(key, file, offset, length)``, written once as a table."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    base = pages.select("page_id", "url", payload.alias("payload"))
    base = base.withColumn("digest", F.sha2("payload", 256))
    large = base.select("page_id", "digest", F.octet_length("payload").alias("n")).where(F.col("n") >= MIN_REVISIT)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("times")).where("times > 1")
    marked = base.join(first.drop("times"), "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = marked.select(
        capture_key(F.col("url"), F.col("page_id")).alias("key"), "page_id", "url", "payload", "digest", refers.cast("long").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        out, at, name = None, 0, ""
        for b in batches:
            keys, files, offsets, lengths = [], [], [], []
            for i in range(b.num_rows):
                key, page, url, payload, digest, refers_to = (c[i].as_py() for c in b.columns)
                data = gzip.compress(record(page, url, payload, digest, refers_to), 6, mtime=0)
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                out.write(data)
                keys.append(key)
                files.append(name)
                offsets.append(at)
                lengths.append(len(data))
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                ["key", "file", "offset", "length"])
        if out is not None:
            out.close()

    return stored(rows.mapInArrow(run, "key string, file string, offset long, length long"), "warc-captures")


def write_index(captures: DataFrame, folder: str, files: int) -> list[tuple[str, str]]:
    """Write the index of ``captures`` in at most ``files`` files; ``(first key, file)`` of each, by key."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        name, out, at, directory, first, pending = uuid.uuid4().hex, None, 0, [], None, []

        def flush() -> int:
            nonlocal at, pending
            data = zlib.compress("\n".join("\t".join(map(str, r)) for r in pending).encode("utf-8", "surrogatepass"), 6)
            directory.append(f"{pending[0][0]}\t{at}\t{len(data)}")
            out.write(data)
            at += len(data)
            pending = []
            return at

        for pdf in batches:
            if out is None and len(pdf):
                out, first = store.open_output_stream(f"{root}/{name}.cdx"), pdf["key"].iloc[0]
            for r in pdf.itertuples(index=False):
                pending.append(r)
                if len(pending) == BLOCK:
                    flush()
        if out is not None:
            if pending:
                flush()
            out.close()
            with store.open_output_stream(f"{root}/{name}.dir") as d:
                d.write(zlib.compress("\n".join(directory).encode("utf-8", "surrogatepass")))
            yield pd.DataFrame({"first": [first], "file": [name]})

    top = stored(captures.select("key", "file", "offset", "length").repartitionByRange(files, "key", "file", "offset")
                 .sortWithinPartitions("key", "file", "offset").mapInPandas(run, "first string, file string"), "warc-index")
    found = [(r["first"], r["file"]) for r in top.collect()]  # one row per index file
    return sorted(found, key=lambda r: r[0].encode("utf-8", "surrogatepass"))


def lookup(queries: DataFrame, top: list[tuple[str, str]], index: str, archives: str) -> DataFrame:
    """``(key)`` distinct -> the records captured under each key, read from the archives."""
    encode = lambda s: s.encode("utf-8", "surrogatepass")
    firsts, names = [encode(f) for f, _ in top], [n for _, n in top]

    def where(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # equal keys may reach back into the file before: start at the first file that can hold the key
            low = [max(bisect.bisect_left(firsts, encode(k)) - 1, 0) for k in pdf["key"]]
            high = [max(bisect.bisect_right(firsts, encode(k)) - 1, 0) for k in pdf["key"]]
            rows = [(k, f) for k, a, b in zip(pdf["key"], low, high) for f in range(a, b + 1)]
            yield pd.DataFrame(rows, columns=["key", "at"]).astype({"at": "int32"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, at, starts, blocks, block, lines, heads = _Files(), -1, [], [], -1, [], []
        for pdf in batches:
            out = []
            for key, f in zip(pdf["key"], pdf["at"]):
                k = encode(key)
                if f != at:
                    store, root = _store(index)
                    with store.open_input_file(f"{root}/{names[f]}.dir") as d:
                        parts = [x.rsplit(b"\t", 2) for x in zlib.decompress(d.read()).split(b"\n")]
                    starts, blocks = [p[0] for p in parts], [(int(p[1]), int(p[2])) for p in parts]
                    at, block = f, -1
                b = max(bisect.bisect_left(starts, k) - 1, 0)
                while b < len(starts) and starts[b] <= k:
                    if b != block:
                        data = zlib.decompress(files.read(f"{index}/{names[f]}.cdx", *blocks[b]))
                        lines = [x.rsplit(b"\t", 3) for x in data.split(b"\n")]
                        heads, block = [x[0] for x in lines], b
                    for i in range(bisect.bisect_left(heads, k), bisect.bisect_right(heads, k)):
                        _, name, offset, length = lines[i]
                        got = parse(gzip.decompress(files.read(f"{archives}/{name.decode()}", int(offset), int(length))))
                        if got["payload_digest"] != got["stated"]:
                            raise ValueError(f"damaged record {name.decode()} at {offset.decode()}")
                        out.append((got["page_id"], got["url"], got["payload_bytes"], got["payload_digest"], got["record_type"],
                                    got["refers_to"], got["payload"]))
                    b += 1
            frame = pd.DataFrame(out, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})
        files.close()

    dealt = queries.select("key").distinct().mapInPandas(where, "key string, at int")
    return dealt.repartition(max(len(top), 1), "at").sortWithinPartitions("at", "key").mapInPandas(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, index the captures, and read every page back through the index."""
    ship(spark)
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    archives, index = shared_folder(spark, "warc"), shared_folder(spark, "warc-index")
    captures = write_archives(pages, archives)
    top = write_index(captures, index, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not top:
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    queries = pages.select(capture_key(F.col("url"), F.col("page_id")).alias("key"))
    return lookup(queries, top, index, archives).drop("payload", "url")


#: What the archives must give back, from the table itself.
OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d"""
