"""Run identity and session settings shared by every stage."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from daybook import fixed_values as FV

# Settings every stage relies on. Timestamps are rendered in UTC; partition values such as
# processing_date=2024-01-01 stay strings (lexical order = date order) instead of being inferred
# as DATE; AQE coalesces small shuffles and splits skewed join partitions at runtime. A fused
# whole-stage method above 8000 bytes of bytecode is never JIT-compiled by HotSpot and would run
# interpreted (rule masks over many typed columns produce such methods), so Spark is told to fall
# back to per-operator generated code for those stages instead.
SESSION_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def configure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume (idempotent)."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for cutting lineage.

    A cluster names it in ``spark.checkpoint.dir``; only a single-JVM session (``local[...]``: tests,
    local runs) that has none gets ``fallback``. On a cluster an unset folder is an error: a
    machine-local one could not be read by other nodes.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if fallback is None or not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set")
        spark.conf.set("spark.checkpoint.dir", fallback)
        current = fallback
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext; the conf suffices
        pass
    return current


@dataclass(frozen=True)
class RunContext:
    """Identity of one pipeline attempt.

    ``processing_date`` is the logical day (``YYYY-MM-DD``), ``run_id`` the attempt. ``run_ts``
    pins "now" for the whole run so every stage stamps the same time (a rerun that recomputes a
    frame must not see a different ``current_timestamp``).
    """

    processing_date: str
    run_id: str = "manual"
    run_mode: str = "incremental"
    run_ts: _dt.datetime | None = None
    curated_source: str = FV.SOURCE_CURATED
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        _dt.date.fromisoformat(self.processing_date)
        if self.run_mode not in ("incremental", "backfill"):
            raise ValueError(f"unknown run_mode {self.run_mode!r}")

    @staticmethod
    def default_date(interval_end: _dt.date | None = None) -> str:
        """Logical day = end of the scheduling interval minus one day."""
        end = interval_end or _dt.datetime.now(_dt.timezone.utc).date()
        return (end - _dt.timedelta(days=1)).isoformat()

    def now(self) -> Column:
        """The run's timestamp as a literal, or ``current_timestamp()`` when not pinned."""
        if self.run_ts is None:
            return F.current_timestamp()
        return F.lit(self.run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")

    @property
    def window_start(self) -> _dt.datetime:
        return _dt.datetime.fromisoformat(self.processing_date)

    @property
    def window_end(self) -> _dt.datetime:
        return self.window_start + _dt.timedelta(days=1)
