"""Ratings feed: typed -> validated -> event dedupe -> reference routing -> mutable tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.dedupe import dedupe_rating_events, latest_by, latest_master
from daybook.operators.routing import flag_references, known_keys, route
from daybook.operators.typing import type_ratings
from daybook.operators.upsert import latest_wins, upsert
from daybook.operators.validate import split
from daybook.spec import (DUPLICATE_RATING_REASON, RATING_KEYS, RATING_PAIR, RATING_RULES,
                          RATINGS_FOR_ML_SCHEMA, RATINGS_SCHEMA, UNKNOWN_REFERENCE_REASON)


@dataclass
class RatingsBatch:
    typed: DataFrame
    invalid: DataFrame
    kept: DataFrame
    duplicates: DataFrame
    known: DataFrame
    unknown: DataFrame

    def rejects(self) -> DataFrame:
        """Invalid, duplicate and unknown rows in one frame; missing columns are NULL."""
        return (self.invalid.unionByName(self.duplicates, allowMissingColumns=True)
                .unionByName(self.unknown, allowMissingColumns=True))


def outcome(tagged: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every typed row once, with product name and line and what became of it in ``reject_reason`` (NULL:
    known). ``tagged`` is the validated batch (``validate``), best a written table: its rows are read for
    the ranking and the losers; the masters are joined once, to the kept rows, known and unknown alike."""
    valid = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    kept, duplicates = dedupe_rating_events(valid, DUPLICATE_RATING_REASON)
    master = latest_master(products, "productCode").select("productCode", "productName", "productLine")
    flagged = flag_references(kept, [(known_keys(customers, "customerNumber"), "customerNumber", []),
                                     (master, "productCode", ["productName", "productLine"])])
    known = F.col("_has_customerNumber") & F.col("_has_productCode")
    routed = flagged.withColumns({
        "productName": F.when(known, F.col("productName")), "productLine": F.when(known, F.col("productLine")),
        "reject_reason": F.when(~known, F.lit(UNKNOWN_REFERENCE_REASON))}).drop("_has_customerNumber", "_has_productCode")
    return (routed.unionByName(duplicates, allowMissingColumns=True)
            .unionByName(tagged.filter(F.col("reject_reason").isNotNull()), allowMissingColumns=True))


def process(landed: DataFrame, customers: DataFrame, products: DataFrame,
            processing_date: str | None = None) -> RatingsBatch:
    """One or many daily batches (rows keep their own ``processing_date`` unless one is given).

    Customers are only needed as a key set (distinct keys over all partitions); products also
    bring name and line from their newest version.
    """
    typed = type_ratings(landed, processing_date)
    valid, invalid = split(typed, RATING_RULES, mode="first")
    kept, duplicates = dedupe_rating_events(valid, DUPLICATE_RATING_REASON)
    product_master = latest_master(products, "productCode").select("productCode", "productName", "productLine")
    known, unknown = route(kept, [(known_keys(customers, "customerNumber"), "customerNumber", []),
                                  (product_master, "productCode", ["productName", "productLine"])])
    return RatingsBatch(typed, invalid, kept, duplicates, known, unknown)


def batch_ts(processing_date: Column) -> Column:
    """Deterministic processing time of a day's batch: the next day at 02:00 UTC."""
    return F.to_timestamp(processing_date) + F.expr("INTERVAL 26 HOURS")


def to_ratings_for_ml(known: DataFrame, processing_ts: Column | None = None) -> DataFrame:
    ts = processing_ts if processing_ts is not None else batch_ts(F.col("processing_date"))
    return known.withColumn("processing_ts", ts).select(*RATINGS_FOR_ML_SCHEMA.fieldNames())


def merge_events(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Unconditional MERGE on (customer, product, rating time): a re-sent event replaces the stored one."""
    return upsert(target, batch, list(RATING_KEYS))


def latest_per_pair(ratings_for_ml_day: DataFrame) -> DataFrame:
    """Newest rating per (customer, product) in a day's slice, shaped as the ``ratings`` table."""
    keys = list(RATING_PAIR) + ["processing_date"]
    return latest_by(ratings_for_ml_day, keys, ["ratingTimestamp", "ingest_ts"]).select(*RATINGS_SCHEMA.fieldNames())


def merge_latest(state: DataFrame, latest: DataFrame, check_unique: bool = True) -> DataFrame:
    """Conditional MERGE on the pair: a late event (older rating time) never overwrites newer state.

    ``check_unique=False`` skips the duplicate-source check (an extra pass over the source) when
    the source is one day's ``latest_per_pair`` output, which is unique per pair by construction.
    """
    return upsert(state, latest, list(RATING_PAIR), update_when=latest_wins("ratingTimestamp"),
                  check_unique=check_unique)
