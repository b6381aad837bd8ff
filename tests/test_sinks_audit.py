"""Sinks (partition replace, CSV round trip, versioned tables), audit fold, notifications."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from conftest import rows
from daybook.operators.audit import AUDIT_EVENT_SCHEMA, fold, normalise_metrics, run_rollup
from daybook.sources.files import read_landed_csv
from daybook.sinks.tables import (PartitionedTable, replace_partition, schema_clone,
                                  write_landing_csv)
from daybook.sources.notifications import flatten, quarantine

T = dt.datetime


def test_replace_partition_empty_rerun_clears(spark, tmp_dir):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, processing_date string")
    df.write.partitionBy("processing_date").parquet(tmp_dir, mode="overwrite")
    replace_partition(df.filter("v = 999"), tmp_dir, "processing_date", "2024-01-02")
    back = spark.read.parquet(tmp_dir)
    assert rows(back, "v", "processing_date") == [(1, "2024-01-01")]
    replace_partition(spark.createDataFrame([(3, "2024-01-01")], "v int, processing_date string"), tmp_dir,
                      "processing_date", "2024-01-01")
    assert rows(spark.read.parquet(tmp_dir), "v") == [(3,)]


def test_csv_round_trip_keeps_text(spark, tmp_dir):
    data = [("a\nb", 'say "hi"', "x,y;z"), ("", None, "plain"), ("\\N", "\\n\\\\", "\r\n\\"), (" padded ", "\\\n\\\\n", "\\r")]
    df = spark.createDataFrame(data, "c1 string, c2 string, c3 string")
    path = os.path.join(tmp_dir, "csv")
    write_landing_csv(df, path)
    assert rows(read_landed_csv(spark, path, df.schema)) == rows(df)
    assert rows(read_landed_csv(spark, path)) == rows(df)  # columns from the header


def test_large_landing_file_is_split(spark, tmp_dir):
    path = os.path.join(tmp_dir, "big")
    df = spark.range(200_000).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("line\n"), 20).alias("v"))
    write_landing_csv(df.coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        back = read_landed_csv(spark, path)
        assert back.rdd.getNumPartitions() > 3 and back.count() == 200_000
        assert back.filter(F.col("v") != F.repeat(F.lit("line\n"), 20)).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_schema_clone_is_empty_with_types(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    c = schema_clone(df)
    assert c.schema == df.schema and c.count() == 0
    assert "LocalTableScan" in c._jdf.queryExecution().optimizedPlan().toString() or c.count() == 0


def _files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_merge_rewrites_only_touched_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rfml")
    schema = "k int, v int, processing_date string"
    base = spark.createDataFrame([(1, 10, "2024-01-01"), (2, 20, "2024-01-02"), (4, 40, "2024-01-04")], schema)
    t = PartitionedTable(spark, path, base.schema, "processing_date")
    assert t.read() is None
    t.replace(base)
    before = _files(path)
    touched = t.merge(spark.createDataFrame([(2, 21, "2024-01-03"), (3, 30, "2024-01-03")], schema), ["k"])
    assert sorted(touched) == ["2024-01-02", "2024-01-03"]
    after = _files(path)
    untouched = {f for f in before if "2024-01-01" in f or "2024-01-04" in f}
    assert untouched and untouched <= after            # untouched partitions keep their files
    assert not any("2024-01-02" in f for f in after)   # the updated row moved partition
    assert rows(t.read()) == [(1, 10, "2024-01-01"), (2, 21, "2024-01-03"), (3, 30, "2024-01-03"), (4, 40, "2024-01-04")]


def test_partition_values_come_back_as_they_are(spark, tmp_dir):
    schema = "k int, p string"
    values = [(1, None), (2, "a b:c"), (3, "x/y"), (4, "50%=z"), (5, "__x"), (6, "\u00e9")]
    t = PartitionedTable(spark, os.path.join(tmp_dir, "odd"), spark.createDataFrame(values, schema).schema, "p")
    t.replace(spark.createDataFrame(values, schema))
    assert rows(t.read(), "k", "p") == values
    t.merge(spark.createDataFrame([(1, "x/y"), (3, None), (2, "n m")], schema), ["k"])
    assert rows(t.read(), "k", "p") == [(1, "x/y"), (2, "n m"), (3, None), (4, "50%=z"), (5, "__x"), (6, "\u00e9")]
    t.merge(spark.createDataFrame([(4, "x/y")], schema), ["k"])  # a partition of odd spelling loses its last row
    assert rows(t.read(), "k", "p")[3] == (4, "x/y")


def test_audit_fold(spark):
    ev = [("r1", "s", "RUNNING", T(2024, 1, 1, 1), 1, None, None),
          ("r1", "s", "FAILED", T(2024, 1, 1, 2), 2, {"rows_read": "100"}, "ValueError: boom"),
          ("r1", "s", "RUNNING", T(2024, 1, 1, 3), 3, None, None),
          ("r1", "s", "SUCCEEDED", T(2024, 1, 1, 4), 4, None, None),
          ("r1", "t", "RUNNING", T(2024, 1, 1, 1), 5, None, None),
          ("r1", "t", "FAILED", T(2024, 1, 1, 2), 6, None, "x" * 5000)]
    st = {r.stage: r for r in fold(spark.createDataFrame(ev, AUDIT_EVENT_SCHEMA)).collect()}
    s = st["s"]
    assert (s.status, s.started_at, s.completed_at, s.error_message) == ("SUCCEEDED", T(2024, 1, 1, 1),
                                                                         T(2024, 1, 1, 4), None)
    assert s.metrics == {"rows_read": "100"}           # a terminal event without metrics keeps them
    assert len(st["t"].error_message) == 3000
    roll = run_rollup(fold(spark.createDataFrame(ev, AUDIT_EVENT_SCHEMA))).first()
    assert (roll.status, roll.message) == ("FAILED", "Failed or upstream-failed tasks: t")
    assert normalise_metrics({"rows_read": 100, "success": True, "file": "orders.csv"}) == \
        {"rows_read": "100", "success": "1", "file": "orders.csv"}


def test_notifications(spark):
    raw = ('{"Records":[{"eventTime":"2026-09-09T10:00:00Z","s3":{"bucket":{"name":"b"},'
           '"object":{"key":"in/a+b%2Fc.json"}}},{"eventTime":"2026-09-10T00:00:00Z","s3":{"bucket":{"name":"b"},'
           '"object":{"key":"in/d.json"}}}]}')
    wrapped = '{"Message": %s}' % __import__("json").dumps(raw)
    msgs = spark.createDataFrame([("m1", raw), ("m2", wrapped), ("m3", raw[:30])], "message_id string, body string")
    got = rows(flatten(msgs), "message_id", "key", "processing_date")
    assert got == [("m1", "in/a b/c.json", "2026-09-09"), ("m1", "in/d.json", "2026-09-10"),
                   ("m2", "in/a b/c.json", "2026-09-09"), ("m2", "in/d.json", "2026-09-10")]
    assert rows(quarantine(msgs), "message_id") == [("m3",)]


def test_keyed_state_in_buckets(spark, tmp_dir):
    import datetime as dt

    from daybook.operators.upsert import latest_wins

    T = dt.datetime
    path, schema = os.path.join(tmp_dir, "state"), "c long, p string, r int, ts timestamp"
    base = spark.createDataFrame([(1, "A", 3, T(2024, 1, 5)), (2, "A", 3, T(2024, 1, 5)), (None, "A", 9, T(2024, 1, 1))]
                                 + [(i, "B", 1, T(2024, 1, 1)) for i in range(10, 60)], schema)
    t = PartitionedTable(spark, path, base.schema, "bucket", by=F.pmod(F.xxhash64("c", "p"), F.lit(16)), of_keys=True)
    t.replace(base)
    before = _files(path)
    t.merge(spark.createDataFrame([(1, "A", 1, T(2024, 1, 1)), (3, "A", 4, T(2024, 1, 6))], schema), ["c", "p"], latest_wins("ts"))
    assert len(before & _files(path)) >= len(before) - 2     # two keys touch two buckets at most
    t.merge(spark.createDataFrame([(2, "A", 5, T(2024, 1, 7)), (3, "A", 2, T(2024, 1, 8))], schema), ["c", "p"], latest_wins("ts"))
    got = t.read().filter("p = 'A'")
    assert rows(got, "c", "r") == [(1, 3), (2, 5), (3, 2), (None, 9)]     # late event ignored; NULL key kept
    assert t.read().columns == ["c", "p", "r", "ts"] and t.read().count() == 54


def test_curated_columns_grow_and_run_id_stays(spark, tmp_dir):
    from daybook.plans.stages import Lake, _curated_table, write_curated

    lake = Lake(os.path.join(tmp_dir, "lake"))
    write_curated(spark, lake, "t", spark.createDataFrame([(1, "r1")], "k int, run_id string"), "2024-01-01")
    write_curated(spark, lake, "t", spark.createDataFrame([("gold", 2, "r2")], "tier string, k long, run_id string"), "2024-01-02")
    write_curated(spark, lake, "t", spark.createDataFrame([], "k int"), "2024-01-03")
    want = [(1, "r1", None, "2024-01-01"), (2, "r2", "gold", "2024-01-02")]
    assert rows(_curated_table(spark, lake, "t"), "k", "run_id", "tier", "processing_date") == want
    spark.sql(f"DROP TABLE {lake.catalog('t')}")             # another session's catalog: registered from the files
    assert rows(_curated_table(spark, lake, "t"), "k", "run_id", "tier", "processing_date") == want


def test_missing_updated_at_raises(spark, tmp_dir):
    from daybook.context import RunContext
    from daybook.plans.stages import Lake, land_relational

    df = spark.createDataFrame([(1,)], "officeCode int")
    ctx, lake = RunContext("2024-01-01"), Lake(os.path.join(tmp_dir, "lake"))
    with pytest.raises(ValueError, match="updated_at"):
        land_relational(spark, ctx, lake, {"offices": df})
    assert land_relational(spark, ctx, lake, {"offices": df}, snapshots=("offices",))["row_count"] == 1


def test_audit_keeps_the_whole_error(spark):
    from daybook.operators.audit import Audit

    a = Audit(spark, "audit_whole", "r1")
    a.start("s")
    a.fail("s", "x" * 9000, {"check_count": 7})
    assert len(spark.table("audit_whole").filter("status = 'FAILED'").first().error_message) == 9000
    assert len(a.state().first().error_message) == 3000
    run = a.finish().first()
    assert (run.status, run.failed_stages) == ("FAILED", ["s"])
    assert spark.table("audit_whole_runs").count() == 1


def test_notification_faults(spark):
    bodies = {"percent": '{"Records":[{"eventTime":"2026-09-09T10:00:00Z","s3":{"bucket":{"name":"b"},"object":{"key":"a+100%.json"}}}]}',
              "test": '{"Event":"s3:TestEvent"}', "none": '{"Records":[]}', "nos3": '{"Records":[{"eventTime":"2026-09-09T10:00:00Z"}]}',
              "noday": '{"Records":[{"eventTime":"junk","s3":{"bucket":{"name":"b"},"object":{"key":"k"}}}]}', "text": "hello", "list": "[1]",
              "inner": '{"Message":"{\\"Records\\""}'}
    msgs = spark.createDataFrame(list(bodies.items()), "message_id string, body string")
    assert rows(flatten(msgs), "message_id", "key", "processing_date") == [("percent", "a 100%.json", "2026-09-09")]
    assert rows(quarantine(msgs), "message_id", "reject_reason") == [
        ("inner", "malformed notification"), ("list", "malformed notification"), ("noday", "record without a date"),
        ("nos3", "record without bucket or key"), ("text", "malformed notification")]


def test_model_tests_stop_the_run_after_results_are_stored(spark, tmp_dir):
    from daybook.operators.quality import ModelTestError, model_gate, model_tests

    fact = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "id string, v int")
    tests = (("fact", "not_null", "id", None), ("fact", "unique", "id", None), ("fact", "relationships", "v", ("dim", "v")),
             ("fact", "accepted_values", "v", (1, 2)), ("fact", "expression", "v", ">= 2"))
    dim = spark.createDataFrame([(2,)], "v int")
    results = model_tests({"fact": fact, "dim": dim}, tests)
    assert {(r.test, r.failures) for r in results.collect()} == {("not_null", 1), ("unique", 1), ("relationships", 1),
                                                                 ("accepted_values", 0), ("expression", 1)}
    with pytest.raises(ModelTestError, match="fact.id:not_null"):
        model_gate(results)


def test_catalog_table_partition_replace_and_external_registration(spark, tmp_dir):
    from daybook.plans.stages import model_schema
    from daybook.sinks.tables import insert_overwrite_partition
    from daybook.sources.files import catalog_table, register_external

    path = os.path.join(tmp_dir, "curated_orders")
    spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2024-01-02")],
                          "k int, v string, processing_date string").write.partitionBy("processing_date").parquet(path)
    register_external(spark, "ext_orders", path, "k int, v string, processing_date string", "processing_date")
    assert catalog_table(spark, "ext_orders").count() == 3
    assert catalog_table(spark, "ext_orders", processing_date="2024-01-02").count() == 2
    assert catalog_table(spark, "ext_orders", as_of="2024-01-01").count() == 1
    # static partition overwrite through the catalog: an empty replacement clears the partition
    insert_overwrite_partition(spark, spark.createDataFrame([], "k int, v string, processing_date string"),
                               "ext_orders", "processing_date", "2024-01-02")
    assert rows(catalog_table(spark, "ext_orders"), "k") == [(1,)]
    insert_overwrite_partition(spark, spark.createDataFrame([(9, "z", "2024-01-02")],
                                                            "k int, v string, processing_date string"),
                               "ext_orders", "processing_date", "2024-01-02")
    assert rows(catalog_table(spark, "ext_orders"), "k") == [(1,), (9,)]
    assert model_schema("analytics", " marts ") == "marts" and model_schema("analytics") == "analytics"
