"""Merges that die on the way, a catalog that forgets, and the search for the partitions that hold a key."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from daybook.sinks.tables import PartitionedTable

SCHEMA = "k long, v int, day string"


class Died(Exception):
    pass


def die(*_args, **_kw):
    raise Died


def table(spark, tmp_dir, **kw):
    t = PartitionedTable(spark, os.path.join(tmp_dir, "t"), spark.createDataFrame([], SCHEMA).schema, "day", **kw)
    if not t.exists():
        t.replace(spark.range(40).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.format_string("2024-01-%02d", F.col("id") / 10 + 1).alias("day"))
                  .withColumn("day", F.concat(F.lit("2024-01-0"), (F.col("k") / 10 + 1).cast("int").cast("string"))), ["k"])
    return t


def source(spark):
    """Changes key 5 (moving it to the third day), 25, and brings 100."""
    return spark.createDataFrame([(5, 50, "2024-01-03"), (25, 51, "2024-01-03"), (100, 52, "2024-01-05")], SCHEMA)


def expected():
    state = {k: (1, f"2024-01-0{k // 10 + 1}") for k in range(40)} | {5: (50, "2024-01-03"), 25: (51, "2024-01-03"), 100: (52, "2024-01-05")}
    return sorted((k, *v) for k, v in state.items())


def versions(tmp_dir):
    return sorted(f for f in os.listdir(os.path.join(tmp_dir, "t")) if f.startswith("version="))


def test_death_while_writing_changes_nothing(spark, tmp_dir):
    t = table(spark, tmp_dir)
    before = rows(t.read())
    failing = source(spark).withColumn("v", F.when(F.col("k") == 25, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        t.merge(failing, ["k"], check_unique=False)
    assert rows(t.read()) == before
    t.merge(source(spark), ["k"])
    assert rows(t.read()) == expected() and len(versions(tmp_dir)) == 2


def test_death_between_write_and_switch(spark, tmp_dir, monkeypatch):
    t = table(spark, tmp_dir)
    before = rows(t.read())
    with monkeypatch.context() as m:
        write = PartitionedTable._write
        m.setattr(PartitionedTable, "_write", lambda self, *a: (write(self, *a), m.setattr(PartitionedTable, "_switch", die))[0])
        with pytest.raises(Died):
            t.merge(source(spark), ["k"])
    assert rows(t.read()) == before
    again = table(spark, tmp_dir)
    again.merge(source(spark), ["k"])
    assert rows(again.read()) == expected()


def test_death_amid_the_switch(spark, tmp_dir, monkeypatch):
    t = table(spark, tmp_dir)
    with monkeypatch.context() as m:
        switch = PartitionedTable._switch

        def half(self, places):
            if any("2024-01-05" in p for p in places) and "2024-01-05" not in "".join(self._current()):
                switch(self, dict(sorted(places.items())[:1]))
                raise Died
            switch(self, places)

        m.setattr(PartitionedTable, "_switch", half)
        with pytest.raises(Died):
            t.merge(source(spark), ["k"])
    t.merge(source(spark), ["k"])
    assert rows(t.read()) == expected()


def test_catalog_that_forgets_reads_the_newest_committed_files(spark, tmp_dir):
    t = table(spark, tmp_dir)
    t.merge(source(spark), ["k"])
    os.makedirs(os.path.join(tmp_dir, "t", "version=99999999999999999999-dead", "day=2024-01-01"))  # never committed
    spark.sql(f"DROP TABLE {t.name}")
    again = table(spark, tmp_dir)
    assert rows(again.read()) == expected()
    again.merge(spark.createDataFrame([(7, 70, "2024-01-01")], SCHEMA), ["k"])
    assert (7, 70, "2024-01-01") in rows(again.read()) and again.read().count() == 41
    assert "version=99999999999999999999-dead" not in versions(tmp_dir)


def test_full_refresh_drops_what_it_lacks(spark, tmp_dir):
    t = table(spark, tmp_dir)
    t.replace(source(spark).filter("k = 100"), ["k"])
    assert rows(t.read()) == [(100, 52, "2024-01-05")] and len(versions(tmp_dir)) == 1


def test_search_reads_only_partitions_that_may_hold_a_key(spark, tmp_dir):
    """Twenty days of 1,000 orders each, numbered upwards: a late line of one order reads one day's keys."""
    schema = "id string, order_number long, day string"
    t = PartitionedTable(spark, os.path.join(tmp_dir, "facts"), spark.createDataFrame([], schema).schema, "day", zone=["order_number"])
    base = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("id"), F.col("id").alias("order_number"),
                                      F.format_string("d%02d", (F.col("id") / 1000).cast("int")).alias("day"))
    t.replace(base, ["id"])
    late = base.filter("order_number in (3500, 3501)").withColumn("day", F.lit("d19"))
    assert sorted(t.merge(late, ["id"])) == ["d03", "d19"]
    assert t.searched == {"partitions": 20, "likely": 1, "keys": 1000}
    assert t.read().count() == 20_000 and t.read().filter("day = 'd19'").count() == 1002
    # ranges alone would keep every day: the Bloom filter leaves the two that hold a key, and hardly another
    wide = base.filter("order_number in (2500, 17500)").withColumn("day", F.lit("d00"))
    t.merge(wide, ["id"])
    assert t.searched["likely"] <= 4 and t.searched["keys"] <= 4100
    assert t.read().count() == 20_000 and rows(t.read().filter("day = 'd00' and order_number > 999"), "order_number") == [(2500,), (17500,)]
    # new keys beyond all ranges: nothing is read
    t.merge(spark.createDataFrame([("new", 99_999, "d20")], schema), ["id"])
    assert t.searched["keys"] == 0 and t.read().count() == 20_001


def test_search_never_loses_a_key(spark, tmp_dir):
    """Random keys, null keys and null zones, several versions: the search finds what a full scan finds."""
    import random

    rng = random.Random(5)
    schema = "a int, b string, v int, p string"
    draw = lambda n: [(rng.choice([None, *range(60)]), rng.choice([None, "x", "y"]), rng.randrange(9), f"p{rng.randrange(7)}") for _ in range(n)]
    t = PartitionedTable(spark, os.path.join(tmp_dir, "r"), spark.createDataFrame([], schema).schema, "p")
    state = {}
    for n in (0, 80, 30, 5, 1, 40):
        batch = list({(a, b): (a, b, v, p) for a, b, v, p in draw(n)}.values())
        t.merge(spark.createDataFrame(batch, schema), ["a", "b"])
        for r in batch:
            if None in r[:2]:
                state[len(state), "null"] = r
            else:
                state[r[:2]] = r
        assert sorted(map(tuple, t.read().collect()), key=str) == sorted(state.values(), key=str)
