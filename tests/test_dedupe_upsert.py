"""Dedupe tie-breaking, MERGE semantics, late data and their plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from daybook.operators.dedupe import dedupe, latest_by
from daybook.operators.upsert import DuplicateSourceKeyError, assert_unique, insert_if_absent, latest_wins, upsert
from daybook.plans import ratings

T = dt.datetime


def test_newest_wins_nulls_last_and_full_ties(spark):
    df = spark.createDataFrame([
        (1, T(2024, 1, 2), "b"), (1, T(2024, 1, 1), "a"), (1, None, "z"),      # newer / older / null
        (2, T(2024, 1, 1), "x"), (2, T(2024, 1, 1), "y"),                    # equal ts: row tie-break
        (3, None, "n"),                                                       # only a null ts
        (4, T(2024, 1, 1), "d"), (4, T(2024, 1, 1), "d"), (4, T(2024, 1, 1), "d"),  # identical rows
    ], "k int, ingest_ts timestamp, v string")
    kept, losers = dedupe(df, ["k"], ["ingest_ts"], "dup")
    assert rows(kept, "k", "v") == [(1, "b"), (2, "y"), (3, "n"), (4, "d")]
    assert rows(losers, "k", "v") == [(1, "a"), (1, "z"), (2, "x"), (4, "d"), (4, "d")]
    assert kept.count() + losers.count() == df.count()


def test_winner_does_not_depend_on_input_order(spark):
    data = [(1, T(2024, 1, 1), "x", 1.0), (1, T(2024, 1, 1), "x", 2.0), (1, T(2024, 1, 1), "w", 9.0)]
    a = latest_by(spark.createDataFrame(data, "k int, ingest_ts timestamp, v string, w double"), ["k"], ["ingest_ts"])
    b = latest_by(spark.createDataFrame(list(reversed(data)), "k int, ingest_ts timestamp, v string, w double")
                  .repartition(3), ["k"], ["ingest_ts"])
    assert rows(a) == rows(b) == [(1, T(2024, 1, 1), "x", 2.0)]


def test_rank_filter_plans_a_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("timestamp").alias("ingest_ts"))
    plan = latest_by(df, ["k"], ["ingest_ts"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def _state(spark, data):
    return spark.createDataFrame(data, "c long, p string, r int, ts timestamp")


def test_latest_wins_merge(spark):
    target = _state(spark, [(1, "A", 3, T(2024, 1, 5)), (2, "A", 3, T(2024, 1, 5)), (3, "A", 3, T(2024, 1, 5))])
    source = _state(spark, [(1, "A", 1, T(2024, 1, 1)),    # late: keep stored
                            (2, "A", 5, T(2024, 1, 5)),    # equal time: update
                            (3, "A", 4, T(2024, 1, 9)),    # newer: update
                            (4, "A", 2, T(2024, 1, 2))])   # new pair: insert
    out = upsert(target, source, ["c", "p"], latest_wins("ts"))
    assert rows(out, "c", "r") == [(1, 3), (2, 5), (3, 4), (4, 2)]


def test_unconditional_merge_and_null_keys(spark):
    target = _state(spark, [(1, "A", 3, T(2024, 1, 5)), (None, "A", 1, T(2024, 1, 1))])
    source = _state(spark, [(1, "A", 4, T(2024, 1, 6)), (None, "A", 2, T(2024, 1, 1))])
    out = upsert(target, source, ["c", "p"])
    # a NULL key never matches: the target row stays and the source row is inserted
    assert rows(out, "c", "r") == [(1, 4), (None, 1), (None, 2)]
    again = upsert(out, source, ["c", "p"])
    assert again.filter(F.col("c").isNotNull()).count() == 1


def test_duplicate_source_key_raises_when_run(spark):
    target = _state(spark, [(1, "A", 3, T(2024, 1, 5))])
    source = _state(spark, [(1, "A", 4, T(2024, 1, 6)), (1, "A", 5, T(2024, 1, 7))])
    merged = upsert(target, source, ["c", "p"])  # building the frame runs nothing
    with pytest.raises(Exception, match="duplicate source key"):
        merged.collect()
    with pytest.raises(DuplicateSourceKeyError):
        assert_unique(target, source, ["c", "p"])


def test_duplicate_source_key_without_a_target_row_is_inserted(spark):
    target = _state(spark, [(1, "A", 3, T(2024, 1, 5))])
    source = _state(spark, [(2, "A", 4, T(2024, 1, 6)), (2, "A", 5, T(2024, 1, 7))])
    for cond in (None, latest_wins("ts")):
        assert rows(upsert(target, source, ["c", "p"], cond), "c", "r") == [(1, 3), (2, 4), (2, 5)]


def test_null_source_keys_stay_out_of_the_join(spark):
    target = _state(spark, [(1, "A", 3, T(2024, 1, 5)), (None, "A", 1, T(2024, 1, 1))])
    source = _state(spark, [(None, "A", i, T(2024, 1, 1)) for i in range(5)] + [(1, "A", 9, T(2024, 1, 1))])
    out = upsert(target, source, ["c", "p"], latest_wins("ts"))
    assert rows(out, "c", "r") == [(1, 3), (None, 0), (None, 1), (None, 1), (None, 2), (None, 3), (None, 4)]


def test_insert_if_absent_first_writer_wins(spark):
    target = spark.createDataFrame([(101, "Alpha")], "k int, name string")
    batch = spark.createDataFrame([(101, "Other"), (102, "Beta"), (102, "Aaa")], "k int, name string")
    assert rows(insert_if_absent(target, batch, ["k"])) == [(101, "Alpha"), (102, "Aaa")]


def test_day_by_day_merges_equal_single_ranking(spark):
    """Folding days in order with the conditional merge gives the state the queries compute in one
    ranking (rating time, then the later day)."""
    data = [(1, "A", 2, T(2024, 1, 1), T(2024, 1, 1, 5), "s", "2024-01-01"),
            (1, "A", 4, T(2024, 1, 3), T(2024, 1, 3, 5), "s", "2024-01-03"),
            (1, "A", 5, T(2024, 1, 2), T(2024, 1, 4, 5), "s", "2024-01-04"),   # late event
            (2, "B", 1, T(2024, 1, 2), T(2024, 1, 2, 5), "s", "2024-01-02"),
            (2, "B", 3, T(2024, 1, 2), T(2024, 1, 3, 5), "s", "2024-01-03")]   # equal time, later day
    schema = ("customerNumber long, productCode string, productRating int, ratingTimestamp timestamp, "
              "ingest_ts timestamp, source string, processing_date string")
    rfml = spark.createDataFrame(data, schema)
    state = None
    for day in sorted({d[-1] for d in data}):
        latest = ratings.latest_per_pair(rfml.filter(F.col("processing_date") == day))
        state = latest if state is None else ratings.merge_latest(state, latest)
    one_pass = latest_by(rfml, ["customerNumber", "productCode"], ["ratingTimestamp", "processing_date", "ingest_ts"])
    assert rows(state, "customerNumber", "productRating") == rows(one_pass, "customerNumber", "productRating") \
        == [(1, 4), (2, 3)]
