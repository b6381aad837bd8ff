"""Typing: string landing rows -> typed rows, never failing on bad text (bad value -> NULL -> rejected)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from daybook.context import RunContext


WHOLE = ("int", "integer", "bigint", "long")


def to_whole(df: DataFrame, name: str, dtype: str = "int") -> Column:
    """Whole-number typing that rejects fractions instead of truncating (4.5 -> NULL, 4.0 -> 4).

    Text that is a whole number as it stands is cast directly; only what is not goes through a decimal.
    """
    c = F.col(name)
    if isinstance(df.schema[name].dataType, IntegralType):
        return c.try_cast(dtype)
    if isinstance(df.schema[name].dataType, NumericType):
        return F.when(c == F.floor(c), c.try_cast(dtype))
    text = F.trim(c.cast("string"))
    number = text.try_cast("decimal(38,18)")  # 5.0 is 5, 4.5 is none
    return F.coalesce(text.try_cast(dtype), F.when(number == F.floor(number), number.try_cast(dtype)))


def cast_by_rules(df: DataFrame, casts: Iterable[tuple[str, str]]) -> DataFrame:
    """Apply a rule-driven cast list; a listed column absent from the input is skipped.

    ``try_cast`` keeps the reference's non-ANSI behaviour (bad text -> NULL, later rejected by a
    rule) without Spark 4's ANSI errors. One projection, so Catalyst keeps it inside codegen.
    """
    present = set(df.columns)
    typed = {}
    for name, dtype in casts:
        if name not in present:
            continue
        typed[name] = to_whole(df, name, dtype) if dtype in WHOLE else F.col(name).try_cast(dtype)
    for name in ("ingest_ts", "updated_at"):
        if name in present and name not in typed:
            typed[name] = F.col(name).try_cast("timestamp")
    return df.withColumns(typed) if typed else df


def conform(df: DataFrame, spec) -> DataFrame:
    """Align a landed frame to its spec: missing declared columns become NULL text, unknown extra
    columns pass through as they are, a missing key column is an error."""
    missing_keys = [k for k in spec.primary_key if k not in df.columns]
    if missing_keys:
        raise ValueError(f"{spec.name}: key column(s) missing from input: {missing_keys}")
    add = {f.name: F.lit(None).cast("string") for f in spec.schema.fields if f.name not in df.columns}
    return df.withColumns(add) if add else df


def add_ingest_metadata(df: DataFrame, ctx: RunContext, source: Column | str) -> DataFrame:
    """Landing lineage: when, from where, for which logical day, by which attempt."""
    src = F.lit(source) if isinstance(source, str) else source
    return df.withColumns({
        "ingest_ts": ctx.now(),
        "source": src,
        "processing_date": F.lit(ctx.processing_date),
        "run_id": F.lit(ctx.run_id),
    })


def add_curated_metadata(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Curated lineage; the landing ``run_id`` stays, it tells which attempt brought the row."""
    return df.withColumns({"curated_ts": ctx.now(), "source": F.lit(ctx.curated_source)})


def type_ratings(df: DataFrame, processing_date: str | None = None) -> DataFrame:
    """Typed rating events.

    customerNumber bigint (``5.0`` is 5, as for every whole number); productCode trimmed (a blank code stays non-null); productRating int
    (non-integral -> NULL); ratingTimestamp falls back to ingest_ts when missing or unparseable.
    """
    ingest = F.col("ingest_ts").try_cast("timestamp")
    out = df.withColumns({
        "customerNumber": to_whole(df, "customerNumber", "bigint"),
        "productCode": F.trim(F.col("productCode").cast("string")),
        "productRating": to_whole(df, "productRating"),
        "ratingTimestamp": F.coalesce(F.col("ratingTimestamp").try_cast("timestamp"), ingest),
        "ingest_ts": ingest,
    })
    if processing_date is not None:
        out = out.withColumn("processing_date", F.lit(processing_date))
    return out
