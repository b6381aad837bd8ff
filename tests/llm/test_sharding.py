import zlib

import pytest
from pyspark.sql import functions as F

from daybook.llm.sharding import shard_by_size, write_shards


def check(rows, shards, total_rows):
    assert len(rows) == total_rows
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    assert set(by) <= set(range(shards))
    return {k: sum(r["size"] for r in v) for k, v in by.items()}


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = shard_by_size(docs, 16).collect()
    sums = check(rows, 16, docs.count())
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        raw = (text[r["id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["crc"] == zlib.crc32(raw)
    mean, longest = sum(sums.values()) / 16, max(r["size"] for r in rows)
    assert all(abs(s - mean) <= longest + 0.05 * mean for s in sums.values())
    assert rows and sorted(map(tuple, rows)) == sorted(map(tuple, shard_by_size(docs, 16).collect()))


def test_hot_group_is_cut_and_small_groups_are_whole(spark):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same text " * 5).alias("text"))
    rest = spark.range(3000, 9000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") / 3).cast("long").cast("string"), F.lit(" x" * 20)).alias("text"))
    rows = shard_by_size(hot.union(rest), 8, oversample=64).collect()
    sums = check(rows, 8, 9000)
    mean = sum(sums.values()) / 8
    assert all(abs(s - mean) < 0.06 * mean for s in sums.values())
    groups, loads = {}, {}
    for r in rows:
        groups.setdefault(r["key"], set()).add(r["shard"])
        loads[r["range_no"]] = loads.get(r["range_no"], 0) + 1
    assert sum(len(s) > 1 for s in groups.values()) == 1  # only the hot group
    assert max(loads.values()) < 9000 / 20  # and no range holds it


def test_many_tiny_records_fill_no_range(spark):
    tiny = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    large = spark.range(6000, 6200).select(F.col("id").alias("doc_id"), F.repeat(F.col("id").cast("string"), 1000).alias("text"))
    rows = shard_by_size(tiny.union(large), 4).collect()
    check(rows, 4, 6200)
    loads = {}
    for r in rows:
        loads[r["range_no"]] = loads.get(r["range_no"], 0) + 1
    assert max(loads.values()) < 6200 / 8


@pytest.mark.parametrize("shards", [1, 3])
def test_odd_rows(odd_documents, no_documents, shards):
    rows = shard_by_size(odd_documents, shards).collect()
    check(rows, shards, 11)
    assert sorted((r["size"], r["crc"] is None) for r in rows if r["size"] < 2) == [(1, False), (1, True), (1, True)]
    assert shard_by_size(no_documents, shards).collect() == []


def test_written_shards(spark, odd_documents, tmp_path):
    docs = odd_documents.dropDuplicates(["doc_id", "text"])
    placed = shard_by_size(docs, 3)
    write_shards(docs, placed, f"file://{tmp_path}/out")
    back = spark.read.parquet(f"file://{tmp_path}/out")
    assert back.count() == docs.count()
    want = {(r["id"], r["shard"], r["slot"]) for r in placed.collect()}
    assert {(r["doc_id"], int(r["shard"]), r["slot"]) for r in back.collect()} == want
