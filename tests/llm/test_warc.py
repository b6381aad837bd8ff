import base64
import hashlib
import zlib

import pyarrow.fs as pafs
from pyspark.sql import functions as F

from daybook.llm import warc


def want(rows, min_bytes=0):
    latest = {}
    for i, _, html in rows:
        if i is not None:
            latest[html or ""] = max(latest.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        m = latest.get(html or "") if len(raw) >= min_bytes else i
        revisit = m is not None and i != m
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", m if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a.com/x", "same"), (2, "http://a.com/x", "same"), (3, "http://B.a.com:80/", "same"), (4, None, None), (5, "", ""), (6, "no scheme\r\n x", "ü\r\n\r\n日"),
        (7, "http://u@c.org?q=1#f", "WARC/1.1\r\n\r\nx"), (8, "http://a.com/ü", "l" * 500_000), (None, "http://a.com/x", "same"), (None, "http://n.com/", "only null")]


def test_round_trip_of_odd_rows(spark):
    df = spark.createDataFrame([(*r, "k", 1) for r in ROWS], "page_id long, url string, html string, key string, offset int")
    got = warc.round_trip(df)
    assert sorted(map(tuple, got.collect()), key=str) == want(ROWS)
    assert sorted(map(tuple, warc.round_trip(df, min_bytes=5).collect()), key=str) == want(ROWS, 5)
    assert warc.round_trip(df.limit(0)).collect() == []


def test_repeated_rows(spark):
    rows = [ROWS[0], ROWS[0], ROWS[2], ROWS[2]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(map(tuple, warc.round_trip(df).collect()), key=str) == want(rows)


def test_archives_index_and_lookup(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    again = pages.limit(40).withColumn("page_id", F.col("page_id") + 10_000)
    folder = f"file://{tmp_path}/warc"
    captures = warc.write_archives(pages.union(again), folder, archive_bytes=100_000)
    index = warc.build_index(captures, lines_per_block=7, lines_per_shard=50)
    assert len(index.shards) > 2 and index.blocks.count() > 30
    # a plain reader of concatenated gzip members finds every record
    fs, base = pafs.FileSystem.from_uri(folder)
    types = []
    for f in fs.get_file_info(pafs.FileSelector(base)):
        data = fs.open_input_file(f.path).readall()
        while data:
            d = zlib.decompressobj(31)
            head = d.decompress(data) + d.flush()
            assert head.startswith(b"WARC/1.1\r\n") and head.endswith(b"\r\n\r\n")
            types.append(head.split(b"\r\n")[1].decode())
            data = d.unused_data
    assert sorted(types) == ["WARC-Type: response"] * pages.count() + ["WARC-Type: revisit"] * 40
    page = again.orderBy("page_id").first()
    found = {(r["page_id"], r["record_type"], r["payload"] and bytes(r["payload"])) for r in warc.read_url(spark, index, folder, page["url"]).collect()}
    assert (page["page_id"], "response", page["html"].encode()) in found
    assert (page["page_id"] - 10_000, "revisit", None) in found
    assert warc.read_url(spark, index, folder, "http://absent.example/").collect() == []


def test_keys():
    assert warc.surt("https://u:p@WWW.Example.com:8080/A?b#c") == "com,example,www)/A?b"
    assert warc.surt("http://a.b") == "b,a)/" and warc.surt(None) == "-"
    assert warc.capture_key("http://a.b", -5) < warc.capture_key("http://a.b", 3) < warc.capture_key("http://a.b", 20)
