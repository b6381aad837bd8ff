"""Run audit as an append-only event table folded to the latest state per (run_id, stage).

Instead of read-modify-write updates of a key-value store, each stage appends events
(run_id, stage, status, event_ts, seq, metrics, error_message); the current state is an aggregate
with map-side combine, so a run with many events never has to sit whole in one task.

Fold rules (fixed behaviour of the audit writer):
* ``started_at``   first RUNNING ever (a retry keeps it)
* ``status``, ``updated_at`` from the last event
* ``completed_at`` the last event's time when it is terminal; a RUNNING event clears it
* ``error_message`` the last event's error (a RUNNING or a clean terminal event clears it); events keep the
  whole text, the state shows its first ``error_limit`` characters
* ``metrics``      the last non-null metrics of a terminal event (a later event without metrics keeps them)
"""

from __future__ import annotations

import traceback
from dataclasses import dataclass
from typing import Any, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType, TimestampType

from daybook import fixed_values as FV

RUNNING = FV.STATUS_RUNNING
FAILED = FV.STATUS_FAILED
ERROR_LIMIT = FV.ERROR_MESSAGE_LIMIT
MESSAGE_LIMIT = FV.RUN_MESSAGE_LIMIT

AUDIT_EVENT_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("stage", StringType(), False),
    StructField("status", StringType(), False),
    StructField("event_ts", TimestampType(), False),
    StructField("seq", LongType(), False),
    StructField("metrics", MapType(StringType(), StringType()), True),
    StructField("error_message", StringType(), True),
])


def normalise_metrics(metrics: Mapping[str, Any] | None) -> dict[str, str] | None:
    """bool and int become integers (True -> 1), anything else its text."""
    if metrics is None:
        return None
    out = {}
    for k, v in metrics.items():
        out[k] = str(int(v)) if isinstance(v, (bool, int)) else str(v)
    return out


def error_text(exc: BaseException) -> str:
    return f"{type(exc).__name__}: {exc}\n{traceback.format_exc()}"


def fold(events: DataFrame, error_limit: int = ERROR_LIMIT) -> DataFrame:
    """Latest state per (run_id, stage)."""
    order = F.struct("event_ts", "seq")
    terminal = F.col("status") != RUNNING
    last_error = F.max_by(F.col("error_message"), order)
    return (events.groupBy("run_id", "stage").agg(
        F.max_by("status", order).alias("status"),
        F.min(F.when(F.col("status") == RUNNING, F.col("event_ts"))).alias("started_at"),
        F.max("event_ts").alias("updated_at"),
        F.max_by(F.when(terminal, F.col("event_ts")), order).alias("completed_at"),
        F.substring(F.nullif(last_error, F.lit("")), 1, error_limit).alias("error_message"),
        F.max_by(F.col("metrics"), F.when(terminal & F.col("metrics").isNotNull(), order)).alias("metrics"),
    ))


def run_rollup(state: DataFrame, prefix: str = FV.RUN_FAILED_PREFIX, ok_message: str = FV.RUN_OK_MESSAGE,
               message_limit: int = MESSAGE_LIMIT) -> DataFrame:
    """One row per run: FAILED with the sorted failed stage names, else SUCCEEDED.

    ``failed_stages`` holds all of them (bounded by the run's stage count); only the text of
    ``message`` is shown up to ``message_limit`` characters.
    """
    failed = F.sort_array(F.collect_set(F.when(F.col("status") == FAILED, F.col("stage"))))
    any_failed = F.size("failed_stages") > 0
    text = F.when(any_failed, F.concat(F.lit(prefix), F.array_join("failed_stages", ", "))).otherwise(F.lit(ok_message))
    return (state.groupBy("run_id").agg(failed.alias("failed_stages"), F.count(F.lit(1)).alias("stage_count"))
            .select("run_id", F.when(any_failed, F.lit(FAILED)).otherwise(F.lit(FV.STATUS_SUCCEEDED)).alias("status"),
                    F.substring(text, 1, message_limit).alias("message"), "failed_stages", "stage_count"))


def stage_metrics(state: DataFrame) -> DataFrame:
    """The metrics of the folded state, one row per (run_id, stage, metric)."""
    return state.select("run_id", "stage", "status", F.explode("metrics").alias("metric", "value"))


@dataclass
class Audit:
    """Appends audit events to a table (``saveAsTable`` append; one small file per event batch)."""

    spark: SparkSession
    table: str
    run_id: str

    def _append(self, stage: str, status: str, metrics=None, error: str | None = None) -> None:
        import datetime as dt
        import time

        row = (self.run_id, stage, status, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
               time.time_ns(), normalise_metrics(metrics), error or None)
        self.spark.createDataFrame([row], AUDIT_EVENT_SCHEMA).write.mode("append").saveAsTable(self.table)

    def start(self, stage: str) -> None:
        self._append(stage, RUNNING)

    def succeed(self, stage: str, status: str = FV.STATUS_SUCCEEDED, metrics=None) -> None:
        self._append(stage, status, metrics)

    def fail(self, stage: str, exc: BaseException | str, metrics=None) -> None:
        self._append(stage, FAILED, metrics, exc if isinstance(exc, str) else error_text(exc))

    def state(self) -> DataFrame:
        return fold(self.spark.table(self.table).filter(F.col("run_id") == self.run_id))

    def finish(self) -> DataFrame:
        """Run-level status through ``run_rollup``, appended to ``<table>_runs``."""
        out = run_rollup(self.state())
        out.write.mode("append").saveAsTable(f"{self.table}_runs")
        return out
