"""Property tests (hypothesis): exact splits, dedupe partitions its input, idempotent and
order-independent merges."""

import datetime as dt
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from conftest import rows
from daybook.operators.dedupe import dedupe
from daybook.operators.typing import cast_by_rules
from daybook.operators.upsert import latest_wins, upsert
from daybook.operators.validate import split
from daybook.spec import SPECS

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
text = st.sampled_from([None, "", "abc", "0", "-1", " 12 ", "3", "7", "99999999999", "-0.01", "2.50"])


@SETTINGS
@given(st.lists(st.tuples(text, text, text, text), min_size=1, max_size=25))
def test_split_is_exact(spark, data):
    schema = StructType([StructField(c, StringType()) for c in
                         ("orderNumber", "quantityOrdered", "priceEach", "orderLineNumber")])
    typed = cast_by_rules(spark.createDataFrame(data, schema), SPECS["orderdetails"].casts)
    valid, rejected = split(typed, SPECS["orderdetails"].all_rules())
    assert valid.count() + rejected.count() == len(data)
    assert rows(valid.unionByName(rejected.drop("reject_reason"))) == rows(typed)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.sampled_from(["a", "b"])), min_size=1,
                max_size=30))
def test_dedupe_partitions_input(spark, data):
    df = spark.createDataFrame([(k, dt.datetime(2024, 1, 1 + t), v) for k, t, v in data],
                               "k int, ingest_ts timestamp, v string")
    kept, losers = dedupe(df, ["k"], ["ingest_ts"])
    assert kept.count() == len({k for k, _, _ in data})
    assert rows(kept.unionByName(losers)) == rows(df)
    newest = {}
    for k, t, v in data:
        newest[k] = max(newest.get(k, (t, v)), (t, v))
    assert rows(kept, "k", "v") == sorted((k, v) for k, (t, v) in newest.items())


pairs = st.lists(st.tuples(st.integers(0, 3), st.integers(1, 5)), min_size=1, max_size=6,
                 unique_by=lambda x: x[0])


@SETTINGS
@given(st.lists(pairs, min_size=1, max_size=3), st.randoms())
def test_latest_wins_state_independent_of_day_order(spark, days, rnd):
    """With distinct event times, merging the days in any order yields the same state."""
    counter = itertools.count()
    batches = [[(c, "P", r, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=next(counter))) for c, r in day]
               for day in days]
    schema = "c long, p string, r int, ts timestamp"

    def fold(order):
        state = spark.createDataFrame([], schema)
        for b in order:
            state = upsert(state, spark.createDataFrame(b, schema), ["c", "p"], latest_wins("ts"))
        return rows(state)

    shuffled = list(batches)
    rnd.shuffle(shuffled)
    assert fold(batches) == fold(shuffled)


@SETTINGS
@given(pairs, pairs)
def test_merge_is_idempotent(spark, target, source):
    schema = "c long, p string, r int"
    t = spark.createDataFrame([(c, "P", r) for c, r in target], schema)
    s = spark.createDataFrame([(c, "P", r) for c, r in source], schema)
    once = upsert(t, s, ["c", "p"])
    assert rows(upsert(once, s, ["c", "p"])) == rows(once)
    assert rows(once, "c") == sorted({(c,) for c, _ in target} | {(c,) for c, _ in source})
