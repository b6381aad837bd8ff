"""Deterministic "latest version per key".

Winners use ``row_number() = 1``, which Catalyst plans as a partial ``WindowGroupLimit`` before
the shuffle and a final one after it: a hot key is cut to one row per map task before it moves,
so a key holding a third of all rows never lands whole in one task. Losers are found by aggregates
with map-side combine (see ``dedupe``), not by ``row_number() > 1``, which would have to sort every row of a
hot key in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.spec import RATING_KEYS


def _order(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], tiebreak: bool) -> list[Column]:
    cols = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    if tiebreak:
        named = {c for c in order if isinstance(c, str)} | set(keys)
        # Every remaining column, in name order, as final sort keys: full ties are then only
        # between identical rows, so the winner's values never depend on scan order.
        cols += [F.col(c).desc_nulls_last() for c in sorted(df.columns) if c not in named]
    return cols


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], tiebreak: bool = True) -> DataFrame:
    """Newest row per key. ``order`` names are newest-first (DESC NULLS LAST); Columns pass through."""
    w = Window.partitionBy(*keys).orderBy(*_order(df, keys, order, tiebreak))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], reason: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, losers); losers carry ``reject_reason`` when ``reason`` is given.

    Losers take two scans: one aggregate by key counts its rows and finds the newest as a maximum
    (both combined map-side, over rows sorted by key where they hold text; NULL is the smallest, as in the ranking), then the rows of repeated keys
    are grouped as whole rows, and each comes back as often as it occurs, once less if it is the newest.
    """
    kept = latest_by(df, keys, order)
    rest = [*order, *sorted(c for c in df.columns if c not in {*order, *keys})]
    newest = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(rest)])
    repeated = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(newest).alias("_newest")).filter(F.col("_n") > 1)
                .select("_newest", *[F.col(k).alias(f"_dk{i}") for i, k in enumerate(keys)]))
    rows = df.join(repeated, [df[k].eqNullSafe(repeated[f"_dk{i}"]) for i, k in enumerate(keys)])
    times = (rows.withColumn("_won", newest.eqNullSafe(F.col("_newest")).cast("int")).groupBy(*df.columns, "_won")
             .agg((F.count(F.lit(1)).cast("int")).alias("_times")).withColumn("_times", F.col("_times") - F.col("_won")).filter("_times > 0"))
    losers = times.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*df.columns)
    if reason is not None:
        losers = losers.withColumn("reject_reason", F.lit(reason))
    return kept, losers


def dedupe_rating_events(df: DataFrame, reason: str, per_batch: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rating-event dedupe on (customer, product, rating time): newest ingest, then source, then row."""
    keys = list(RATING_KEYS) + (["processing_date"] if per_batch else [])
    return dedupe(df, keys, ["ingest_ts", "source"], reason)


def latest_master(df: DataFrame, key: str) -> DataFrame:
    """Current state of a master table over all partitions: newest processing_date, then ingest_ts."""
    return latest_by(df, [key], ["processing_date", "ingest_ts"])
