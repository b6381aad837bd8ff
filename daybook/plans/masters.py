"""Current masters as keyed state: a day's rows are merged into them, so no day ranks all of history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.operators.dedupe import latest_by, latest_master
from daybook.sinks.tables import PartitionedTable

#: Curated tables of which the newest row per key is kept, and their key.
MASTER_KEYS = {"customers": "customerNumber", "products": "productCode"}
BUCKETS = 64


def master_table(spark: SparkSession, path: str, schema: StructType, key: str) -> PartitionedTable:
    return PartitionedTable(spark, path, schema, "bucket", by=F.pmod(F.xxhash64(key), F.lit(BUCKETS)), of_keys=True)


def refresh_master(table: PartitionedTable, curated: DataFrame, key: str, day: str) -> None:
    """Bring the state up to one day of the curated table, new, back-filled or run again: afterwards it equals
    ``latest_master`` of all its days.

    A key of the day competes with its stored row. A key whose stored row came from an earlier run of the
    same day may have lost that row, so for these keys alone the history is ranked; one that has no row left goes.
    Only the buckets of these keys are read and rewritten.
    """
    order = ["processing_date", "ingest_ts"]
    if not table.exists():
        table.replace(latest_master(curated, key))
        return
    state = table.read()
    rows = curated.filter(F.col("processing_date") == day).select(*table.columns)
    held = state.filter(F.col("processing_date") == day).select(key)
    affected = rows.select(key).union(held).distinct()
    buckets = [r[0] for r in affected.select(table.by.cast("string")).distinct().collect()]  # at most BUCKETS
    if not buckets:
        return
    near = table.read_partitions(buckets)

    def among(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        named = keys.select(F.col(key).alias("_k")).distinct()  # null is a key like any other
        return df.join(named, df[key].eqNullSafe(named["_k"]), how)

    others = among(near, affected, "left_anti")
    again = among(curated.select(*table.columns), held, "left_semi")
    stored = among(among(near, affected, "left_semi"), held, "left_anti")
    table.replace_partitions(others.unionByName(latest_by(again.unionByName(stored).unionByName(rows), [key], order)), buckets)
