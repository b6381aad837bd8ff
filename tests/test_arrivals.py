"""Announced files, broken files, receive counts: nothing of one message or file holds up another."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from daybook.context import RunContext
from daybook.sources.files import json_file_rows, whole_json_files
from daybook.sources.notifications import outcomes, parse, receive_outcomes
from daybook.streaming.ingest import LANDED_RATING_SCHEMA, announced_files, count_receives, message_files

NOW = dt.datetime(2026, 9, 9, 12).timestamp()


def put(path, text, at=NOW):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    os.utime(path, (at, at))


def note(key, day="2026-09-09"):
    return json.dumps({"Records": [{"eventTime": f"{day}T11:00:00Z", "s3": {"bucket": {"name": "b"}, "object": {"key": key}}}]})


def rating(code, stars="4"):
    return json.dumps([{"customerNumber": "101", "productCode": code, "productRating": stars, "ratingTimestamp": "2026-09-09T10:00:00"}])


def test_body_is_parsed_once(spark):
    from conftest import plan_text

    messages = spark.createDataFrame([("m", note("k"))], "message_id string, body string")
    plan = plan_text(outcomes(messages))
    assert plan.count("parse_json(body") + plan.count("try_parse_json(") + plan.count("parse_json(") <= 6
    parsed = parse(messages.unionAll(spark.createDataFrame([("n", None), ("o", ""), ("p", "[1]"), ("q", '{"Records": 5}'), ("r", '{"Message": "x"}'),
                                                            ("s", '{"Message": "{}"}')], messages.schema)))
    assert {r["message_id"]: r["fault"] for r in parsed.collect()} == {
        "m": None, "n": "malformed notification", "o": "malformed notification", "p": "malformed notification", "q": None,
        "r": "malformed notification", "s": None}


def test_all_but_the_missing_file_land(spark, tmp_dir):
    """2,000 announcements, one names a file that never comes."""
    n = 2000
    queue, incoming = (os.path.join(tmp_dir, x) for x in ("queue", "incoming"))
    for i in range(n):
        if i != 777:
            put(f"{incoming}/in/f {i}+.json", rating(f"P{i}"))
    put(f"{queue}/a.txt", "\n".join([*(note(f"in/f+{i}%2B.json") for i in range(n)), note("in/f+3%2B.json"), "not json"]))
    stream = announced_files(spark, message_files(spark, queue), incoming, "1 hour")

    def run():
        stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start(f"{tmp_dir}/out").awaitTermination(240)
        return spark.read.schema(stream.schema).parquet(f"{tmp_dir}/out")

    first = run()
    assert first.filter("reject_reason is not null").count() == 1
    landed = first.filter("source is not null")
    assert landed.count() == n - 1 and landed.select("key").distinct().count() == n - 1
    assert first.filter("source is null and reject_reason is null").count() == 0  # it may still come
    for k in (1, 2):  # time goes on
        put(f"{incoming}/in/late{k}.json", rating("L"), NOW + k * 4 * 3600)
        put(f"{queue}/b{k}.txt", note(f"in/late{k}.json"), NOW + k * 4 * 3600)
        out = run()
    assert [r["key"] for r in out.filter("source is null and reject_reason is null").collect()] == ["in/f 777+.json"]
    assert out.filter("source is not null").count() == n + 1


def test_stage_sets_bad_files_and_messages_aside(spark, tmp_dir):
    from daybook.plans.stages import Lake, ratings_for_ml_table, stream_arrivals

    lake, ts = Lake(os.path.join(tmp_dir, "lake")), dt.datetime(2026, 9, 9, 1)
    spark.createDataFrame([(101, "A", ts, "2026-09-09")], "customerNumber long, customerName string, ingest_ts timestamp, "
                          "processing_date string").write.partitionBy("processing_date").parquet(lake.curated("customers"))
    spark.createDataFrame([("P1", "Car", "Cars", ts, "2026-09-09")], "productCode string, productName string, productLine string, "
                          "ingest_ts timestamp, processing_date string").write.partitionBy("processing_date").parquet(lake.curated("products"))
    incoming, queue = os.path.join(tmp_dir, "incoming"), os.path.join(tmp_dir, "queue")
    put(f"{incoming}/good.json", rating("P1"))
    put(f"{incoming}/broken.json", rating("P1")[:-1])
    put(f"{queue}/q.txt", "\n".join([note("good.json"), note("gone.json"), note("broken.json"), "{"]))
    ctx = RunContext("2026-09-30", run_id="q", run_ts=dt.datetime(2026, 9, 30, 2))
    for k in (0, 1, 2):
        put(f"{queue}/later{k}.txt", "{}", NOW + 4 * 3600 * k)
        put(f"{incoming}/later{k}.json", "[]", NOW + 4 * 3600 * k)
        stream_arrivals(spark, ctx, lake, queue, incoming, os.path.join(tmp_dir, "ck"), wait="1 hour").awaitTermination(180)
    assert rows(ratings_for_ml_table(spark, lake).read(), "productCode", "productRating") == [("P1", 4)]

    def aside(kind):
        return spark.read.parquet(f"{lake.root}/quarantine/{kind}/run_id=q")

    assert rows(aside("missing_files"), "key") == [("gone.json",)]
    assert rows(aside("files"), "_broken") == [(rating("P1")[:-1],)]
    assert rows(aside("notifications"), "reject_reason") == [("malformed notification",)]


def test_json_files(spark, tmp_dir):
    texts = {"a": rating("A"), "b": "", "c": '{"customerNumber": 7, "productCode": "C"}', "d": "[]", "e": '[{"productCode": "E"}, {"productCode": "F"', "f": "plain text",
             "g": "[\n " + rating("G")[1:-1] + ",\n" + rating("H")[1:-1] + "\n]"}
    for name, text in texts.items():
        put(f"{tmp_dir}/in/{name}.json", text)
    out = json_file_rows(whole_json_files(spark.read, f"{tmp_dir}/in"), LANDED_RATING_SCHEMA).collect()
    got = sorted((r["source"][-6], r["productCode"], r["_broken"]) for r in out if r["_broken"] is None)
    assert got == [("a", "A", None), ("c", "C", None), ("g", "G", None), ("g", "H", None)]
    assert sorted((r["source"][-6], r["_broken"]) for r in out if r["_broken"] is not None) == [("e", texts["e"]), ("f", "plain text")]
    assert [r["customerNumber"] for r in out if r["productCode"] == "C"] == ["7"]


def receives(seed=3, n=400):
    rng = random.Random(seed)
    return [(f"m{min(rng.randrange(60), rng.randrange(60))}", i, dt.datetime(2026, 9, 9) + dt.timedelta(seconds=i // 3), rng.random() < 0.25) for i in range(n)]


RECEIVES = "message_id string, receive_id long, received_at timestamp, ok boolean"


def brute_outcomes(data, most=3):
    out = {}
    for m in {r[0] for r in data}:
        failed, status, at = 0, "waiting", None
        for _, _, t, ok in sorted((r for r in data if r[0] == m), key=lambda r: (r[2], r[1])):
            failed += not ok
            if ok or failed == most:
                status, at = "done" if ok else "dead", t
                break
        out[m] = (status, failed + (status == "done"), at)
    return out


@pytest.mark.parametrize("most", [1, 3, 5])
def test_receive_outcomes(spark, most):
    data = receives() + [("only", 9_000 + i, dt.datetime(2026, 9, 10), False) for i in range(2000)] + [("null", 1, dt.datetime(2026, 9, 10), None)]
    got = {r[0]: tuple(r[1:]) for r in receive_outcomes(spark.createDataFrame(data, RECEIVES), most).collect()}
    assert got == brute_outcomes(data, most)


def test_receive_count_survives_a_failed_batch(spark, tmp_dir):
    """Receives come in files, in order; a batch whose sink fails is run again. Each message is told once, as the table says."""
    data, state = receives(), {"fail": True, "out": {}}

    def sink(batch, epoch):
        found = [tuple(r) for r in batch.collect()]
        if epoch == 1 and state["fail"]:
            state["fail"] = False
            raise RuntimeError("sink is gone")
        state["out"][epoch] = found

    for part in range(4):
        spark.createDataFrame(data[100 * part:100 * part + 100], RECEIVES).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        stream = count_receives(spark.readStream.schema(RECEIVES).parquet(f"{tmp_dir}/in"))
        for _ in range(2):
            try:
                stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_dir}/ck").outputMode("append").trigger(availableNow=True).start().awaitTermination(180)
                break
            except Exception as e:  # noqa: BLE001 - the planted failure
                assert "sink is gone" in str(e)
    assert not state["fail"]
    told = [r for found in state["out"].values() for r in found]
    assert len(told) == len({r[0] for r in told})
    want = {m: x for m, x in brute_outcomes(data).items() if x[0] != "waiting"}
    assert {m: (s, n, t) for m, s, n, t in told} == want and {s for s, _, _ in want.values()} == {"done", "dead"}
