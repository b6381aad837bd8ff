"""Stored column types: widened without loss, values that fit nowhere set aside."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from conftest import rows
from daybook.context import RunContext
from daybook.plans.stages import Lake, _curated_table, write_curated
from daybook.sinks.tables import fit_types, wider_type


@pytest.mark.parametrize("stored, given, wide", [
    ("int", "int", "int"), ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("tinyint", "smallint", "smallint"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "decimal(4,4)", "decimal(24,4)"), ("decimal(10,0)", "decimal(5,3)", "decimal(13,3)"),
    ("decimal(38,0)", "decimal(38,10)", "decimal(38,0)"), ("int", "double", "double"), ("float", "double", "double"), ("smallint", "float", "double"), ("float", "smallint", "float"),
    ("bigint", "double", "bigint"), ("double", "bigint", "double"), ("date", "timestamp", "date"), ("timestamp", "date", "timestamp"),
    ("int", "string", "int"), ("string", "int", "string"), ("boolean", "int", "boolean"), ("array<int>", "array<bigint>", "array<int>")])
def test_wider_type(spark, stored, given, wide):
    def of(text):
        return T._parse_datatype_string(text)

    assert wider_type(of(stored), of(given)).simpleString() == wide


@pytest.mark.parametrize("stored, given, values, kept, lost", [
    ("int", "string", ["7", " 8 ", "x", "", "5000000000", None], [7, 8, None], ["x", "", "5000000000"]),
    ("bigint", "double", [1.0, 2.5, float("nan"), 1e30], [1], [2.5, float("nan"), 1e30]),
    ("double", "bigint", [5, (1 << 53) + 1], [5.0], [(1 << 53) + 1]),
    ("decimal(4,2)", "string", ["1.25", "1.5", "999", "a"], [Decimal("1.25"), Decimal("1.50")], ["999", "a"]),
    ("string", "int", [5, None], ["5", None], []),
    ("string", "double", [0.1, 1e300], ["0.1", "1.0E300"], []),
    ("date", "string", ["2024-02-29", "2023-02-29"], [dt.date(2024, 2, 29)], ["2023-02-29"]),
    ("boolean", "string", ["true", "maybe"], [True], ["maybe"])])
def test_values_that_fit(spark, stored, given, values, kept, lost):
    df = spark.createDataFrame([(v,) for v in values], f"v {given}")
    typed, wide = fit_types(df, T._parse_datatype_string(f"v {stored}"))
    assert wide.simpleString() == f"struct<v:{stored}>"
    assert [r.v for r in typed.filter("_misfit is null").collect()] == kept
    assert [str(r._given.v) for r in typed.filter("_misfit is not null").collect()] == list(map(str, lost))


def test_no_value_is_lost_over_four_days(spark, tmp_dir):
    lake = Lake(f"{tmp_dir}/lake")
    days = [("int", [1, None, -3]), ("bigint", [5_000_000_000]), ("decimal(6,3)", [Decimal("0.125"), Decimal("-999.999")]), ("string", ["42", "abc", "7.5"])]
    for n, (kind, values) in enumerate(days, 1):
        ctx = RunContext(f"2024-01-0{n}", "r")
        rejected = write_curated(spark, lake, "t", spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"k int, v {kind}"), ctx.processing_date, ctx)
        assert rejected == (1 if kind == "string" else 0)
    got = rows(_curated_table(spark, lake, "t"), "processing_date", "k", "v")
    want = [("2024-01-01", 0, Decimal(1)), ("2024-01-01", 1, None), ("2024-01-01", 2, Decimal(-3)), ("2024-01-02", 0, Decimal(5_000_000_000)),
            ("2024-01-03", 0, Decimal("0.125")), ("2024-01-03", 1, Decimal("-999.999")), ("2024-01-04", 0, Decimal(42)), ("2024-01-04", 2, Decimal("7.5"))]
    assert got == want
    bad = spark.read.parquet(f"{lake.root}/rejected_zone/t_types").collect()
    assert [(r.k, r.v, r.reject_reason) for r in bad] == [(1, "abc", "value does not fit the stored column: v")]


def test_a_misfit_fails_a_write_without_rejects(spark, tmp_dir):
    lake = Lake(f"{tmp_dir}/lake")
    write_curated(spark, lake, "t", spark.createDataFrame([(1,)], "v int"), "2024-01-01")
    with pytest.raises(Exception, match="does not fit the stored column: v"):
        write_curated(spark, lake, "t", spark.createDataFrame([("1",), ("x",)], "v string"), "2024-01-02")
    assert rows(_curated_table(spark, lake, "t"), "v") == [(1,)]


@pytest.mark.parametrize("first, second, a, b", [("smallint", "float", 300, 0.5), ("int", "double", -7, 1e300), ("float", "double", 0.5, 1e300), ("tinyint", "int", 5, 70_000),
                                                 ("decimal(4,2)", "decimal(12,3)", Decimal("12.34"), Decimal("123456789.125")),
                                                 ("date", "timestamp", dt.date(2024, 1, 2), dt.datetime(2024, 1, 3))])
def test_older_files_are_read_in_the_wider_type(spark, tmp_dir, first, second, a, b):
    lake = Lake(f"{tmp_dir}/lake")
    write_curated(spark, lake, "t", spark.createDataFrame([(a,)], f"v {first}"), "2024-01-01")
    write_curated(spark, lake, "t", spark.createDataFrame([(b,)], f"v {second}"), "2024-01-02")
    want = [a, b.date() if isinstance(b, dt.datetime) else b]
    assert [r.v for r in _curated_table(spark, lake, "t").orderBy("processing_date").collect()] == want
