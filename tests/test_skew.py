"""One key holding a third of all rows: results stay whole and exact, and the plans reduce the hot
key before it is shuffled (partial WindowGroupLimit / partial aggregation)."""

from pyspark.sql import functions as F

from conftest import plan_text
from daybook.operators.audit import fold
from daybook.operators.dedupe import dedupe

N = 60_000


def _skewed(spark):
    # key 0 holds a third of the rows; other keys hold 1-2 rows each
    return (spark.range(N).repartition(8)
            .select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                    (F.col("id") * 7 % 1000).cast("timestamp").alias("ingest_ts"),
                    (F.col("id") % 5).cast("string").alias("v")))


def test_hot_key_dedupe_is_exact(spark):
    df = _skewed(spark)
    kept, losers = dedupe(df, ["k"], ["ingest_ts"], "dup")
    n_keys = df.select("k").distinct().count()
    assert kept.count() == n_keys
    assert kept.count() + losers.count() == N
    hot = kept.filter("k = 0").first()
    assert hot.ingest_ts == df.filter("k = 0").agg(F.max("ingest_ts")).first()[0]
    plan = plan_text(kept)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def _shuffle_records(df):
    """Records written by each shuffle of the executed (final AQE) plan, read from SQL metrics."""
    out = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("ShuffleQueryStage"):
            walk(node.plan())
            return
        if name == "Exchange":
            m = node.metrics().get("shuffleRecordsWritten")
            if m.isDefined():
                out.append(m.get().value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(df._jdf.queryExecution().executedPlan().executedPlan())
    return out


def test_hot_key_is_cut_before_the_shuffle(spark):
    """The shuffle under the rank filter carries at most one row per key per map task, not the
    hot key's 20,000 rows."""
    df = _skewed(spark)
    kept, _ = dedupe(df, ["k"], ["ingest_ts"])
    kept.write.format("noop").mode("overwrite").save()
    written = _shuffle_records(kept)
    n_keys = df.select("k").distinct().count()
    n_map_tasks = 8
    assert written and max(written) <= n_keys - 1 + n_map_tasks < N


def test_hot_run_audit_fold(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    ev = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), F.col("id").cast("string")))
         .alias("run_id"),
        F.lit("stage").alias("stage"),
        F.when(F.col("id") == N - 3, F.lit("FAILED")).otherwise(F.lit("RUNNING")).alias("status"),
        (F.lit(base).cast("timestamp") + F.make_interval(secs=F.col("id").cast("int"))).alias("event_ts"),
        F.col("id").alias("seq"),
        F.lit(None).cast("map<string,string>").alias("metrics"),
        F.lit(None).cast("string").alias("error_message"))
    st = fold(ev)
    hot = st.filter("run_id = 'hot'").first()
    assert hot.status == "FAILED" and hot.started_at == base
    assert "HashAggregate" in plan_text(st) or "SortAggregate" in plan_text(st)


def test_hot_key_join_is_split(spark):
    """A sort-merge join on a hot key: AQE's skew handling splits the hot partition; rows stay whole."""
    left = _skewed(spark)
    right = spark.range(N).select(F.col("id").alias("k"), F.lit(1).alias("one"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "k", "inner")
        assert joined.count() == N
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
