"""Scans: incremental windows, dated landing partitions, JDBC tables, catalog tables."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import ArrayType, StringType, StructType

from daybook.context import RunContext


def window_scan(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows with ``start <= column < end``; both bounds are plain comparisons, so they reach the
    Parquet scan (``PushedFilters``) or the database (JDBC pushdown)."""
    c = F.col(column)
    return df.filter((c >= F.to_timestamp(F.lit(start))) & (c < F.to_timestamp(F.lit(end))))


def day_window_scan(df: DataFrame, column: str, ctx: RunContext) -> DataFrame:
    """The run's logical day, half-open ``[D, D + 1 day)``."""
    return window_scan(df, column, ctx.window_start.isoformat(sep=" "), ctx.window_end.isoformat(sep=" "))


def _jdbc_literal(value) -> str:
    """A value in SQL that every JDBC driver takes (escape syntax for dates and times)."""
    if isinstance(value, datetime.datetime):
        return f"{{ts '{value.isoformat(sep=' ')}'}}"
    return f"{{d '{value.isoformat()}'}}" if isinstance(value, datetime.date) else str(value)


def quantile_cuts(column: DataFrame, parts: int) -> list:
    """Ascending values that cut the rows of a one-column frame (numbers, dates or timestamps) into ``parts`` of
    about equal size; fewer where a value repeats over several parts."""
    name, kind = column.columns[0], column.schema[0].dataType.simpleString()
    number = {"date": F.unix_date(name), "timestamp": F.unix_micros(name)}.get(kind, F.col(name)).alias("v")
    shares = [i / parts for i in range(1, parts)]
    cuts = column.select(number).agg(F.percentile_approx("v", shares, 10_000)).first()[0] or []
    back = {"date": F.date_from_unix_date(F.col("c").cast("int")), "timestamp": F.timestamp_micros("c")}.get(kind, F.col("c"))
    spark = column.sparkSession
    found = spark.createDataFrame([(c,) for c in sorted(set(cuts))], f"c {'bigint' if kind in ('date', 'timestamp') else kind}") if cuts else None
    return [r[0] for r in found.select(back.alias("v")).orderBy("v").collect()] if found is not None else []


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str, properties: dict | None = None,
               num_partitions: int | None = None, whole: str | None = None, even: bool = False) -> DataFrame:
    """A database table, read in parallel ranges of ``partition_column`` (a number, date or timestamp).

    The ranges hold about as many rows each, however the values lie: the cuts are quantiles of the column, which is
    read alone for them, in parallel even steps between its least and largest value (over the rows that ``whole``
    selects if given). ``even`` takes these steps themselves as ranges and saves that reading. The cuts only place
    the borders, no row is left out. As many ranges as the cluster has cores, unless ``num_partitions`` says otherwise.
    """
    def reader(dbtable: str):
        r = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable)
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        return r

    where = f" where {whole}" if whole else ""
    low, high = reader(f"(select min({partition_column}) as lo, max({partition_column}) as hi from {table}{where}) b").load().first()
    if low is None or low == high:
        return reader(table).load()
    n = num_partitions or spark.sparkContext.defaultParallelism

    def steps(dbtable: str, column: str) -> DataFrame:
        return (reader(dbtable).option("partitionColumn", column).option("lowerBound", str(low))
                .option("upperBound", str(high)).option("numPartitions", n).load())

    if even or n < 2:
        return steps(table, partition_column)
    cuts = quantile_cuts(steps(f"(select {partition_column} as part_value from {table}{where}) q", "part_value"), n)
    if not cuts:
        return reader(table).load()
    values = [_jdbc_literal(c) for c in cuts]
    ranges = [f"{partition_column} < {values[0]} or {partition_column} is null"]
    ranges += [f"{partition_column} >= {a} and {partition_column} < {b}" for a, b in zip(values, values[1:], strict=False)]
    ranges.append(f"{partition_column} >= {values[-1]}")
    return spark.read.jdbc(url, table, predicates=ranges, properties=properties or {})


def incremental_jdbc(spark: SparkSession, url: str, table: str, ctx: RunContext, partition_column: str,
                     column: str = "updated_at", **kw) -> DataFrame:
    """Rows changed on the run's day (the window pushes down to the database as a WHERE clause)."""
    window = f"{column} >= {_jdbc_literal(ctx.window_start)} and {column} < {_jdbc_literal(ctx.window_end)}"
    return day_window_scan(jdbc_table(spark, url, table, partition_column, whole=kw.pop("whole", window), **kw), column, ctx)


def read_landed_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A landed CSV partition (``sinks.tables.write_landing_csv``): one record per line, so large files
    are split over tasks. Without a schema the header names the columns and all are text (no inference); an
    empty day still carries its header, so its columns survive."""
    from daybook.sinks.tables import CSV_ESCAPES, CSV_NULL

    reader = spark.read.option("header", True).option("escape", '"').option("nullValue", CSV_NULL).option("emptyValue", "")
    df = (reader.schema(schema) if schema is not None else reader).csv(path)

    def unescaped(name: str) -> Column:
        (backslash, doubled), *others = CSV_ESCAPES

        def plain(part: Column) -> Column:
            for raw, code in others:
                part = F.replace(part, F.lit(code), F.lit(raw))
            return part

        # between doubled backslashes a backslash can only be the start of another escape
        parts = F.split(F.col(name), doubled.replace("\\", "\\\\"))
        return F.when(F.instr(F.col(name), backslash) > 0, F.array_join(F.transform(parts, plain), backslash)).otherwise(F.col(name)).alias(name)

    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[unescaped(c) if c in text else F.col(c) for c in df.columns])


def read_landed_json(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """A landed JSON partition with a declared schema (an empty directory would infer ``struct<>``)."""
    return (spark.read.schema(schema).option("multiLine", multiline)
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").json(path))


MALFORMED_FILE = "malformed JSON file"


def whole_json_files(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """``source, file_time, content``: one row per file of a folder, whatever is in it. Each file is read by one
    task and held whole, as multi-line JSON is anyway; an empty file has no row."""
    files = reader.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_modification_time").alias("file_time"),
                        F.col("value").alias("content"))


def json_file_rows(files: DataFrame, schema: StructType, content: str = "content") -> DataFrame:
    """The objects of JSON files (an array of them or a single one) as typed rows, next to the files' other columns.

    A file that is no JSON gives one row that keeps its text in ``_broken``, so it can be set aside whole; of
    the others ``_broken`` is null. A file with an empty array gives no rows.
    """
    rows = F.from_json(content, ArrayType(schema))
    broken = F.array(F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]))
    held = F.transform(F.array(rows), lambda r: F.struct(F.coalesce(r, broken).alias("rows"), r.isNull().alias("broken")))
    parsed = files.select("*", F.explode(held).alias("_file")).select("*", F.explode("_file.rows").alias("_row"))
    text = F.when(F.col("_file.broken"), F.coalesce(F.col(content), F.lit(""))).alias("_broken")
    return parsed.select(*[c for c in files.columns if c != content], "_row.*", text)


def catalog_table(spark: SparkSession, name: str, processing_date: str | None = None,
                  as_of: str | None = None) -> DataFrame:
    """A catalog table, optionally one partition (equality) or all partitions up to a day."""
    df = spark.table(name)
    if processing_date is not None:
        df = df.filter(F.col("processing_date") == processing_date)
    if as_of is not None:
        df = df.filter(F.col("processing_date") <= as_of)
    return df


def register_external(spark: SparkSession, name: str, path: str, schema_ddl: str,
                      partition_column: str | None = None) -> None:
    """External Parquet table over curated files, with partitions recovered from the layout."""
    part = f" PARTITIONED BY ({partition_column})" if partition_column else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING parquet{part} LOCATION '{path}'")
    from daybook.sinks.tables import path_exists

    if partition_column and path_exists(spark, path):
        spark.catalog.recoverPartitions(name)
