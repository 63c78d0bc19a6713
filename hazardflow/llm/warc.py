"""WARC archives with a two-level capture index: write, look up, and read back by byte ranges.

Writing: every page becomes a WARC/1.1 record, gzipped alone, in archives that tasks write straight into the
shared folder. Of records with equal payloads (by SHA-1) the one with the largest page id holds the payload
(``response``), the others refer to it (``revisit``); payloads below ``min_revisit`` bytes are always written.
A task's archives carry the attempt's own random name, and only captures of committed attempts are indexed,
so a task that runs twice leaves an unused file and no wrong index entry.

Index: captures are keyed by the reversed host (``com,example,www)/path``) and page id, range-partitioned and
sorted into shards, and packed into zlib-compressed blocks of ``LINES`` lines. Level one is the list of shard
starts (one entry for ``SHARD_LINES`` captures, at most ``MAX_SHARDS``: a proven size to broadcast); level two
is the sparse directory of block starts inside a shard. A lookup searches both by bisection, unpacks one block,
bisects in it, and the found ranges are read from the archives, in the order of their offsets.

Defined results: null html is an empty payload; null urls have an empty key; null page ids sort below all
others; repeated rows with the largest id are all responses; an empty table gives empty archives and index.
Files go through ``pyarrow.fs`` to wherever ``spark.checkpoint.dir`` points (file, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .columns import lower_ascii, text_of
from .tables import shared_path, written

LINES = 3000
SHARD_LINES = 300_000
MAX_SHARDS = 65_536
ARCHIVE_BYTES = 512 << 20
READ_SPAN = 16 << 20  # bytes of an archive that one read task takes
#: Record fields of the format. The tables have no capture time, so the date is a constant.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def capture_key(url: Column, page_id: Column) -> Column:
    """Reversed host, path and query (no scheme, no fragment), then the page id."""
    host = lower_ascii(F.regexp_extract(text_of(url), r"(?s)\A.*?://([^/?#]*)", 1))
    rest = F.regexp_extract(text_of(url), r"(?s)\A.*?://[^/?#]*([^#]*)", 1)
    surt = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.concat(F.regexp_replace(surt, r"[\x00-\x20\x7F]", "%20"), F.lit(" "), F.coalesce(page_id.cast("string"), F.lit("")))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record(page_id: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One gzipped WARC record; with ``refers_to`` (a page id) a revisit without the payload."""
    target = re.sub(r"[\x00-\x20\x7f]", "%20", url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{RECORD_ID}{page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if target:
        head.append(f"WARC-Target-URI: {target}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    return {p[0].lower(): p[1] for p in pairs if len(p) == 2}


def parse(data: bytes) -> dict:
    """Fields of one gzipped record; the digest of a response is taken from its payload and must match."""
    raw = gzip.decompress(data)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    page = lambda v: v.strip("<>").removeprefix(RECORD_ID) or None
    out = {"page_id": page(fields["warc-record-id"]), "record_type": fields["warc-type"], "payload_digest": digest,
           "refers_to": None, "payload_bytes": len(payload), "payload": payload}
    if out["record_type"] == "revisit":
        out["refers_to"] = page(fields["warc-refers-to"])
        out["payload_bytes"], out["payload"] = int(_fields(http)["content-length"]), None
    elif base32_sha1(payload) != digest:
        raise ValueError(f"payload digest of {fields['warc-record-id']} does not match")
    return out


class _Archive:
    """An archive being written: rolls over to a new file after ``ARCHIVE_BYTES``."""

    def __init__(self, folder: str):
        self.fs, self.folder = open_fs(folder)
        self.attempt, self.nth, self.stream, self.at = uuid.uuid4().hex, 0, None, 0

    def add(self, data: bytes) -> tuple[str, int]:
        if self.stream is None or self.at >= ARCHIVE_BYTES:
            self.close()
            self.fs.create_dir(self.folder, recursive=True)
            self.name, self.at, self.nth = f"{self.attempt}-{self.nth:05d}.warc.gz", 0, self.nth + 1
            self.stream = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        at = self.at
        self.stream.write(data)
        self.at += len(data)
        return self.name, at

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


def write_archives(pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", content: str = "html",
                   min_revisit: int = 0) -> DataFrame:
    """Write ``pages`` to archives in ``folder``; (key, archive, offset, length) of the captures, written as a table."""
    ship_package(pages.sparkSession)
    payload = text_of(F.col(content))
    rows = pages.select(F.col(key).alias("_id"), text_of(F.col(url)).alias("_url"), capture_key(F.col(url), F.col(key)).alias("key"),
                        payload.alias("_payload"), F.sha1(payload).alias("_sha1"))
    holders = rows.where(F.octet_length("_payload") >= min_revisit).groupBy("_sha1").agg(F.max("_id").alias("_holder"))
    joined = rows.join(holders, "_sha1", "left")
    revisit = (F.octet_length("_payload") >= min_revisit) & ~F.col("_id").eqNullSafe(F.col("_holder"))
    ready = joined.select(F.coalesce(F.col("_id").cast("string"), F.lit("")), "_url", "key", "_payload",
                          F.when(revisit, F.col("_holder").cast("string")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Archive(folder)
        for batch in batches:
            names, offsets, lengths = [], [], []
            for page_id, url_, _, text, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                body = text.encode("utf-8")
                data = record(page_id, url_, body, base32_sha1(body), refers_to)
                name, at = archive.add(data)
                names.append(name)
                offsets.append(at)
                lengths.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(names, pa.string()), pa.array(offsets, pa.int64()),
                                              pa.array(lengths, pa.int64())], names=["key", "archive", "offset", "length"])
        archive.close()

    return written(ready.mapInArrow(run, "key string, archive string, offset long, length long"), "captures")


def _pack(lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, nth = TaskContext.get().partitionId(), [], 0

        def block(part: list[tuple]) -> pa.RecordBatch:
            body = "\n".join("\t".join(map(str, row)) for row in part).encode("utf-8")
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([nth], pa.int32()), pa.array([part[0][0]], pa.string()),
                 pa.array([len(part)], pa.int32()), pa.array([zlib.compress(body)], pa.binary())],
                names=["shard", "block", "first_key", "lines", "data"])

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            while len(held) > lines:
                # equal keys stay in one block, so a block starts with the first capture of its first key
                cut = lines
                while cut < len(held) and held[cut][0] == held[cut - 1][0]:
                    cut += 1
                if cut == len(held):
                    break
                yield block(held[:cut])
                held, nth = held[cut:], nth + 1
        if held:
            yield block(held)
    return run


def build_index(captures: DataFrame, *, lines: int = LINES, shard_lines: int = SHARD_LINES) -> DataFrame:
    """(shard, block, first_key, lines, data): sorted captures in compressed blocks, written as a table."""
    n = captures.count()
    shards = min(MAX_SHARDS, max(1, -(-n // shard_lines)))
    ordered = captures.select("key", "archive", "offset", "length").repartitionByRange(shards, "key").sortWithinPartitions("key", "archive", "offset")
    return written(ordered.mapInArrow(_pack(lines), "shard int, block int, first_key string, lines int, data binary"), "index")


def _search_shard(keys: pa.Table, blocks: pa.Table) -> pa.Table:
    directory = sorted(zip(blocks.column("first_key").to_pylist(), range(blocks.num_rows)))  # the sparse block directory
    starts, places = [d[0] for d in directory], [d[1] for d in directory]
    found: list[tuple[str, str, int, int]] = []
    now, lines, heads = -1, [], []
    for key in sorted(keys.column("key").to_pylist()):
        at = bisect.bisect_right(starts, key) - 1
        if at < 0:
            continue
        if at != now:
            body = zlib.decompress(blocks.column("data")[places[at]].as_py()).decode("utf-8")
            lines = [line.split("\t") for line in body.split("\n")]
            now, heads = at, [line[0] for line in lines]
        i = bisect.bisect_left(heads, key)
        while i < len(heads) and heads[i] == key:
            found.append((key, lines[i][1], int(lines[i][2]), int(lines[i][3])))
            i += 1
    cols = list(zip(*found)) or [(), (), (), ()]
    return pa.table({"key": pa.array(cols[0], pa.string()), "archive": pa.array(cols[1], pa.string()),
                     "offset": pa.array(cols[2], pa.int64()), "length": pa.array(cols[3], pa.int64())})


def look_up(keys: DataFrame, index: DataFrame) -> DataFrame:
    """(key, archive, offset, length) of all captures of the distinct ``key``s."""
    ship_package(index.sparkSession)
    starts = sorted((r["first"], r["shard"]) for r in index.groupBy("shard").agg(F.min("first_key").alias("first")).collect())
    level_one = index.sparkSession.sparkContext.broadcast(starts)  # at most MAX_SHARDS entries

    def to_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, numbers = [s[0] for s in level_one.value], [s[1] for s in level_one.value]
        for batch in batches:
            at = [bisect.bisect_right(firsts, k) - 1 for k in batch.column(0).to_pylist()]
            shard = pa.array([numbers[i] if i >= 0 else -1 for i in at], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), shard], names=["key", "shard"])

    dealt = keys.select("key").distinct().mapInArrow(to_shard, "key string, shard int").where("shard >= 0")
    return dealt.groupBy("shard").cogroup(index.select("shard", "first_key", "data").groupBy("shard")).applyInArrow(
        _search_shard, "key string, archive string, offset long, length long")


def read_ranges(ranges: DataFrame, folder: str, *, parts: int = 1, id_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """Records at (archive, offset, length): page_id, payload_bytes, payload_digest, record_type, refers_to (and payload).

    ``parts`` read tasks, each of whole spans of archives in the order of their offsets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, where = open_fs(folder)
        name, stream = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != name:
                    if stream is not None:
                        stream.close()
                    name, stream = archive, files.open_input_file(f"{where}/{archive}")
                rows.append(parse(stream.read_at(length, offset)))
            cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            if with_payload:
                cols, types = cols + ["payload"], types + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(cols, types)], names=cols)
        if stream is not None:
            stream.close()

    span = F.floor(F.col("offset") / F.lit(READ_SPAN))
    dealt = ranges.select("archive", "offset", "length").repartition(parts, "archive", span).sortWithinPartitions("archive", "offset")
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    read = dealt.mapInArrow(run, schema + (", payload binary" if with_payload else ""))
    return read.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, *, key: str = "page_id", url: str = "url",
                  content: str = "html", min_revisit: int = 0, with_payload: bool = False) -> DataFrame:
    """Write ``pages`` to archives, index them, look every page up and read its record back."""
    folder = folder or shared_path(spark, "warc")
    captures = write_archives(pages, folder, key=key, url=url, content=content, min_revisit=min_revisit)
    index = build_index(captures)
    keys = pages.select(capture_key(F.col(url), F.col(key)).alias("key"))
    size = captures.agg(F.sum("length")).first()[0] or 0
    return read_ranges(look_up(keys, index), folder, parts=max(1, -(-size // READ_SPAN)), id_type=pages.schema[key].dataType.simpleString(), with_payload=with_payload)


def op5_warc(spark, sf_dir: str) -> DataFrame:
    return archive_pages(spark, spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS holder,
        array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER + 1, 1)), '') AS payload_digest
      FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM d
"""
