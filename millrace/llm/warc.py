"""Operator 8: WARC archives with revisit records and a two-level capture index.

* One job finds, for every payload digest that repeats, its smallest page id (minima before the shuffle).
* Archives: a task a range of reversed-host keys, each record its own gzip member, so a record can be read
  alone by offset and length, and a retried task writes the same bytes.  As the index has the same order,
  a part of it leads to few archives, read from front to back.
* Index level 1: lines sorted by reversed-host key, in zlib blocks.  Level 2: a sparse directory, one
  line a block, in one file a part, found by the parts' first keys.  A lookup is two binary searches,
  one block and one range read.
* Reading all records back goes through the index blocks as well.

Input cases: null html is an empty payload; null or unparsable urls get the key ")" + url; a null page_id
sorts before all others and is written as such; rows repeating a page_id are each written, and those
that hold the smallest id of their payload are all responses; payloads under 100 bytes are always
responses; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import zlib
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bloom
from .common import NULL_ID, id_key, open_input, partitions, put_bytes, save, schema_of, shared_folder, tidy

#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 100
#: Index lines in one block.
LINES = 256
#: Revisits that are broadcast rather than met through a Bloom filter: a few megabytes.
SMALL = 50_000
#: Fixed capture time: the tables carry none.
DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def surt(url: str | None) -> str:
    """Reversed-host key: http://www.Example.com/a?b -> com,example,www)/a?b."""
    url = (url or "").replace("\n", "%0A").replace("\t", "%09")
    try:
        u = urlsplit(url)
        host = u.hostname
    except ValueError:
        host = None
    if not host:
        return ")" + url
    port = f":{u.port}" if _port(u) not in (None, 80, 443) else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def _port(u) -> int | None:
    try:
        return u.port
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def _surts(urls: pd.Series) -> pd.Series:
    return urls.map(lambda u: surt(None if pd.isna(u) else u))


def record(page: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit holds the HTTP head only."""
    head = _HTTP % len(payload)
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 5, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes | None]:
    """Headers of a record, and its payload (None for a revisit)."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Type"] == "revisit":
        return fields, None
    return fields, block.partition(b"\r\n\r\n")[2]


def _urn(x: str) -> int | None:
    n = int(x.rpartition(":")[2].rstrip(">"))
    return None if n == NULL_ID else n


def revisits(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(key, digest, refers_to) of the pages whose payload also belongs to a smaller page id."""
    html = F.coalesce(F.col("html"), F.lit(""))
    marks = save(pages.where(F.octet_length(html) >= least).select(id_key("page_id").alias("key"), F.sha2(html, 256).alias("digest")), "digests")
    first = marks.groupBy("digest").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("digest", "low")
    return marks.join(first, "digest").where("key > low").select("key", "digest", F.col("low").alias("refers_to")).distinct()


def write_warc(pages: DataFrame, folder: str | None = None) -> tuple[str, list[tuple[str, int, int]]]:
    """Write archives and index; (folder, [(first key, part, blocks)] of the index parts, in key order)."""
    import pyarrow as pa

    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    n = partitions(spark)
    rows = pages.select(id_key("page_id").alias("key"), "url", F.coalesce(F.col("html"), F.lit("")).alias("html"), F.sha2(F.coalesce(F.col("html"), F.lit("")), 256).alias("digest"))
    again = save(revisits(pages), "revisits")
    k = again.count()
    if k <= SMALL:
        rows = rows.join(F.broadcast(again), ["key", "digest"], "left")
    else:
        clear, suspects = bloom.split(rows, again, ["key", "digest"], k)
        rows = clear.withColumn("refers_to", F.lit(None).cast("long")).unionByName(suspects.join(again, ["key", "digest"], "left"))
    by = ["surt", "key", "digest"]
    rows = rows.withColumn("surt", _surts("url")).repartitionByRange(n, *by).sortWithinPartitions(*by, "url")

    def archive(batches):
        from pyspark import TaskContext

        part, told = TaskContext.get().partitionId(), []

        def chunks():
            at = 0
            for b in batches:
                for place, key, url, html, digest, to in zip(*(b.column(c).to_pylist() for c in ("surt", "key", "url", "html", "digest", "refers_to")), strict=True):
                    m = record(key, url, html.encode(), digest, to)
                    told.append((place, key, part, at, len(m)))
                    at += len(m)
                    yield m

        made = chunks()
        first = next(made, None)
        if first is None:
            return

        def again():
            yield first
            yield from made

        put_bytes(f"{folder}/{part:05d}.warc.gz", again())
        for lo in range(0, len(told), 10_000):
            cols = list(zip(*told[lo : lo + 10_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])], names=["surt", "key", "part", "at", "size"])

    lines = save(rows.select("surt", "key", "url", "html", "digest", "refers_to").mapInArrow(tidy(archive), schema_of(surt="string", key="long", part="long", at="long", size="long")), "captures")

    def index(batches):
        from pyspark import TaskContext

        part, marks = TaskContext.get().partitionId(), []

        def chunks():
            at, block, first = 0, [], None

            def packed():
                data = zlib.compress("".join(block).encode(), 6)
                marks.append((first, at, len(data)))
                return data

            for b in batches:
                for row in zip(*(b.column(c).to_pylist() for c in ("surt", "key", "part", "at", "size")), strict=True):
                    first = row[0] if not block else first
                    block.append("\t".join(map(str, row)) + "\n")
                    if len(block) == LINES:
                        data = packed()
                        yield data
                        at += len(data)
                        block = []
            if block:
                yield packed()

        made = chunks()
        start = next(made, None)
        if start is None:
            return

        def again():
            yield start
            yield from made

        put_bytes(f"{folder}/{part:05d}.cdx", again())
        put_bytes(f"{folder}/{part:05d}.dir", iter(["".join(f"{k}\t{a}\t{s}\n" for k, a, s in marks).encode()]))
        yield pa.RecordBatch.from_arrays([pa.array([marks[0][0]], pa.string()), pa.array([part], pa.int64()), pa.array([len(marks)], pa.int64())], names=["first", "part", "blocks"])

    ordered = lines.repartitionByRange(n, "surt", "key", "part", "at").sortWithinPartitions("surt", "key", "part", "at")
    told = save(ordered.mapInArrow(tidy(index), schema_of(first="string", part="long", blocks="long")), "index")
    return folder, sorted(((r["first"], r.part, r.blocks) for r in told.collect()), key=lambda x: x[1])


class CaptureIndex:
    """Lookups by url: binary search over parts, then over a part's directory, then in one block."""

    def __init__(self, folder: str, parts: list[tuple[str, int, int]]):
        self.folder, self.parts = folder, parts
        self._dirs: dict[int, list[tuple[str, int, int]]] = {}

    def directory(self, part: int) -> list[tuple[str, int, int]]:
        if part not in self._dirs:
            with open_input(f"{self.folder}/{part:05d}.dir") as f:
                rows = (x.split("\t") for x in f.read().decode().split("\n")[:-1])
                self._dirs[part] = [(k, int(a), int(s)) for k, a, s in rows]
        return self._dirs[part]

    def block(self, part: int, k: int) -> list[tuple[str, int, int, int, int]]:
        _, at, size = self.directory(part)[k]
        with open_input(f"{self.folder}/{part:05d}.cdx") as f:
            f.seek(at)
            rows = (x.split("\t") for x in zlib.decompress(f.read(size)).decode().split("\n")[:-1])
            return [(r[0], *map(int, r[1:])) for r in rows]

    def captures(self, url: str | None) -> list[tuple[str, int, int, int, int]]:
        key, out = surt(url), []
        # the first place that can hold the key is the last one that starts before it
        p = max(0, bisect.bisect_left([x[0] for x in self.parts], key) - 1)
        for first, part, _ in self.parts[p:]:
            if first > key:
                break
            firsts = [x[0] for x in self.directory(part)]
            for k in range(max(0, bisect.bisect_left(firsts, key) - 1), len(firsts)):
                if firsts[k] > key:
                    break
                out += [r for r in self.block(part, k) if r[0] == key]
        return out

    def read(self, capture: tuple) -> tuple[dict[str, str], bytes | None]:
        _, _, part, at, size = capture
        with open_input(f"{self.folder}/{part:05d}.warc.gz") as f:
            f.seek(at)
            return parse(f.read(size))


def read_warc(spark: SparkSession, folder: str, parts: list[tuple[str, int, int]]) -> DataFrame:
    """Every record by the index: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    A task takes the index parts one by one and reads their captures in order of archive and offset.
    Digests and lengths of responses are taken from their payloads and must equal the headers'.
    """
    import pyarrow as pa

    schema = schema_of(page_id="long", payload_bytes="long", payload_digest="string", record_type="string", refers_to="long", url="string")
    if not parts:
        return spark.createDataFrame([], schema)

    def run(batches):
        index = CaptureIndex(folder, parts)
        for b in batches:
            for i in b.column(0).to_pylist():
                _, part, n_blocks = parts[i]
                for lo in range(0, n_blocks, 16):
                    want = sorted((c for k in range(lo, min(n_blocks, lo + 16)) for c in index.block(part, k)), key=lambda c: c[2:4])
                    rows, opened, f = [], None, None
                    for c in want:
                        if opened != c[2]:
                            if f is not None:
                                f.close()
                            opened, f = c[2], open_input(f"{folder}/{c[2]:05d}.warc.gz")
                        f.seek(c[3])
                        head, payload = parse(f.read(c[4]))
                        size, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].partition(":")[2]
                        if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
                        to = head.get("WARC-Refers-To")
                        rows.append((_urn(head["WARC-Record-ID"]), size, digest, head["WARC-Type"], _urn(to) if to else None, head["WARC-Target-URI"]))
                    if f is not None:
                        f.close()
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k in (2, 3, 5) else pa.int64()) for k, c in enumerate(cols)], names=schema.names)

    return spark.range(0, len(parts), 1, len(parts)).mapInArrow(tidy(run), schema)


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, parts = write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_warc(spark, folder, parts).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
m AS (SELECT payload_digest, min(page_id) AS low FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
       CASE WHEN m.low < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m.low < d.page_id THEN m.low END AS refers_to
FROM d LEFT JOIN m ON d.payload_bytes >= 100 AND d.payload_digest = m.payload_digest
"""
