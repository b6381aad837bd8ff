"""WARC archives with a two-level capture index.

Records are written as gzip members, one archive after another per task. The captures' reversed-host
keys are sorted into compressed blocks; a sparse directory holds the first key of every block. A
lookup searches the directory, then the block, and reads just the record's byte range.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.shared import materialise, scratch_path, text_batches

CAPTURED_AT = "1970-01-01T00:00:00Z"  # the tables name no time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 128 << 20  # of records for each reading task
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then path and query; no scheme, port or fragment."""
    m = re.match(r".*?://([^/?#]*)([^#]*)", url or "", re.S)
    if not m:
        return "-" if not url else re.sub(r"\s", "%20", url)
    host = re.sub(r":\d*$", "", m[1].rpartition("@")[2]).lower()
    return re.sub(r"\s", "%20", ",".join(reversed(host.split("."))) + ")" + (m[2] or "/"))


def capture_key(url: str | None, page_id: int | None) -> str:
    """Index key: the URL's sort key and the record's number, so that captures of one URL differ."""
    return f"{surt(url)} {'-' if page_id is None else format(page_id + (1 << 63), '020d')}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    block = HTTP + b"\r\n" if revisit else HTTP + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", CAPTURED_AT), ("WARC-Target-URI", re.sub(r"\s", "%20", url or "about:blank")),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if revisit:
        head[2:2] = [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(5, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record's gzip member."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(value: str) -> int | None:
    number = value[len("<urn:page:"):-1]
    return int(number) if number else None


def write_archives(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0, archive_bytes: int = 1 << 30) -> DataFrame:
    """Write a record per row to archives in ``folder`` and return the captures ``key, page_id, file,
    offset, length``.

    Of rows with equal payloads of at least ``min_bytes`` bytes those with the largest id are responses,
    the others revisit it. Null payloads are empty; a null id is smaller than any other; rows that repeat
    an id and a payload are all responses or all revisits. The captures are a written table, and only
    archives of finished task attempts are in it: a lost executor leaves an archive that no index names.
    """
    text_batches(pages.sparkSession)
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("html"))
    src = src.withColumn("sha", F.sha1("html"))
    sizes = src.select("page_id", "sha", F.octet_length("html").alias("n")).where(F.col("n") >= min_bytes)
    latest = sizes.groupBy("sha").agg(F.max("page_id").alias("latest"), F.count("*").alias("n")).where("n > 1 and latest is not null").drop("n")
    revisits = sizes.join(latest, "sha").where(~F.col("page_id").eqNullSafe(F.col("latest"))).select(
        F.col("page_id").alias("rid"), F.col("sha").alias("rsha"), "latest").distinct()
    revisits = materialise(revisits, "revisits")
    told = src.join(revisits, F.col("page_id").eqNullSafe(F.col("rid")) & (F.col("sha") == F.col("rsha")), "left") \
        .select("page_id", "url", "html", "latest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, name, offset = None, "", 0
        try:
            for b in batches:
                for lo in range(0, b.num_rows, 256):
                    rows = []
                    for r in b.slice(lo, 256).to_pylist():
                        if out is None or offset >= archive_bytes:
                            if out is not None:
                                out.close()
                            name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                            out = fs.open_output_stream(f"{base}/{name}", compression=None)
                        data = record(r["page_id"], r["url"], r["html"], digest32(r["html"]), r["latest"], r["latest"] is not None)
                        out.write(data)
                        rows.append((capture_key(r["url"], r["page_id"]), r["page_id"], name, offset, len(data)))
                        offset += len(data)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                        ["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return materialise(told.mapInArrow(run, "key string, page_id long, file string, offset long, length long"), "captures")


@dataclass
class CaptureIndex:
    """``blocks(shard, block, first_key, data)`` and the first key of every shard."""

    blocks: DataFrame
    shards: list[int]
    first_keys: list[str]


def build_index(captures: DataFrame, *, lines_per_block: int = 1000, lines_per_shard: int = 100_000, max_shards: int = 65_536) -> CaptureIndex:
    """Sort the captures by key into compressed blocks of ``lines_per_block`` lines; a shard is a key
    range of about ``lines_per_shard`` lines. The driver holds one key per shard, ``max_shards`` at most."""
    shards = min(max_shards, max(1, -(-captures.count() // lines_per_shard)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, lines = TaskContext.get().partitionId(), 0, []

        def flush() -> pa.RecordBatch:
            data = zlib.compress("\n".join(lines).encode(), 6)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([json.loads(lines[0])[0]]), pa.array([data], pa.binary())],
                ["shard", "block", "first_key", "data"])

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lines.append(json.dumps(r, ensure_ascii=False))
                if len(lines) == lines_per_block:
                    yield flush()
                    block, lines = block + 1, []
        if lines:
            yield flush()

    ordered = captures.select("key", "page_id", "file", "offset", "length").repartitionByRange(shards, "key", "file", "offset") \
        .sortWithinPartitions("key", "file", "offset")
    blocks = materialise(ordered.mapInArrow(run, "shard int, block int, first_key string, data binary"), "index_blocks")
    tops = blocks.groupBy("shard").agg(F.min("first_key").alias("first")).orderBy("first", "shard").collect()
    return CaptureIndex(blocks, [r["shard"] for r in tops], [r["first"] for r in tops])


def lookup(index: CaptureIndex, keys: DataFrame) -> DataFrame:
    """``keys(lo, hi)``, distinct -> ``page_id, file, offset, length`` of the captures with
    ``lo <= key <= hi``. A key range goes to the shards it touches; in a shard the directory of first keys is searched for the
    blocks, and only those are opened."""
    shards, first = index.shards, index.first_keys

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, shard = [], []
            for i, (lo, hi) in enumerate(zip(b.column("lo").to_pylist(), b.column("hi").to_pylist(), strict=True)):
                # the shard before the first one that starts at lo may hold it too
                for n in range(max(0, bisect.bisect_left(first, lo) - 1), bisect.bisect_right(first, hi)):
                    row.append(i)
                    shard.append(shards[n])
            out = b.take(pa.array(row, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), out.column("lo"), out.column("hi")], ["shard", "lo", "hi"])

    def search(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        blocks = blocks.sort_by("block")
        directory, data = blocks.column("first_key").to_pylist(), blocks.column("data")
        opened, lines, line_keys, out = -1, [], [], set()
        # neighbouring keys share blocks, so one open block at a time is enough
        for lo, hi in sorted(zip(asked.column("lo").to_pylist(), asked.column("hi").to_pylist(), strict=True)):
            for n in range(max(0, bisect.bisect_left(directory, lo) - 1), bisect.bisect_right(directory, hi)):
                if n != opened:
                    opened, lines = n, [tuple(json.loads(x)) for x in zlib.decompress(data[n].as_py()).decode().split("\n")]
                    line_keys = [x[0] for x in lines]
                out.update(lines[bisect.bisect_left(line_keys, lo):bisect.bisect_right(line_keys, hi)])
        cols = list(zip(*sorted(out, key=lambda x: x[2:]), strict=True)) or [()] * 5
        return pa.table({"page_id": pa.array(cols[1], pa.int64()), "file": pa.array(cols[2], pa.string()),
                         "offset": pa.array(cols[3], pa.int64()), "length": pa.array(cols[4], pa.int64())})

    routed = keys.select("lo", "hi").mapInArrow(route, "shard int, lo string, hi string")
    return routed.groupBy("shard").cogroup(index.blocks.groupBy("shard")).applyInArrow(
        search, "page_id long, file string, offset long, length long")


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """Range-read the records at ``file, offset, length``: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to, payload`` (of a revisit: no payload, and null bytes). A payload that its
    digest doesn't match raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        name, file = "", None
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                rows = []
                for r in b.slice(lo, 256).to_pylist():
                    if r["file"] != name:
                        if file is not None:
                            file.close()
                        name, file = r["file"], fs.open_input_file(f"{base}/{r['file']}")
                    headers, payload = parse(file.read_at(r["length"], r["offset"]))
                    revisit = headers["WARC-Type"] == "revisit"
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and digest32(payload) != digest:
                        raise ValueError(f"damaged record at {r}")
                    rows.append((_urn(headers["WARC-Record-ID"]), None if revisit else len(payload), digest, headers["WARC-Type"],
                                 _urn(headers["WARC-Refers-To"]) if revisit else None, None if revisit else payload))
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
        if file is not None:
            file.close()

    # as many tasks as the bytes read ask for, each a range of places: a large file is read by several
    total = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(places.sparkSession.sparkContext.defaultParallelism, -(-total // READ_BYTES))
    by_place = places.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return by_place.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write the archives and their index, look every page up in it and read its record back:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``, one row per record. A revisit's
    bytes are those of the response that it refers to, as read back. No pages give no rows."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "archives")
    index = build_index(write_archives(pages, folder, id_col=id_col, url_col=url_col, html_col=html_col, min_bytes=min_bytes))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = pa.array([capture_key(u, i) for u, i in zip(b.column("url").to_pylist(), b.column("id").to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([k, k], ["lo", "hi"])

    keys = pages.select(F.col(url_col).alias("url"), F.col(id_col).cast("long").alias("id")).mapInArrow(key, "lo string, hi string").distinct()
    read = materialise(read_records(materialise(lookup(index, keys), "places"), folder).drop("payload"), "records")
    sizes = read.where("record_type = 'response'").groupBy(F.col("page_id").alias("rid"), F.col("payload_digest").alias("rdigest")) \
        .agg(F.max("payload_bytes").alias("rbytes"))
    resolved = read.join(sizes, (F.col("refers_to") == F.col("rid")) & (F.col("payload_digest") == F.col("rdigest")), "left")
    return resolved.select("page_id", F.coalesce("payload_bytes", "rbytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def read_url(spark: SparkSession, index: CaptureIndex, folder: str, url: str) -> DataFrame:
    """All captures of one URL with their payloads, by index and range reads."""
    k = surt(url)
    keys = spark.range(1).select(F.lit(k + " ").alias("lo"), F.lit(k + "!").alias("hi"))
    return read_records(lookup(index, keys), folder)
