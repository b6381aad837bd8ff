"""File-arrival notifications: queue message bodies -> (bucket, key, processing_date).

A body is either a storage event (``{"Records": [...]}``) or a topic envelope whose ``Message`` is
that event as text. A body that is not JSON, and one with a record that names no bucket, key or
date, goes to the quarantine instead of failing the batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RECORDS = "array<struct<eventTime: string, s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def decoded_key(key: Column) -> Column:
    """``+`` is a space, ``%XX`` a byte; a key that is not validly encoded keeps its percent signs."""
    return F.coalesce(F.try_url_decode(key), F.translate(key, "+", " "))


def parse(messages: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``records`` and ``fault`` (null: the message is good, also one without records, such as a
    test event: there is nothing to do). The body is parsed once, and so is the text of its ``Message``;
    what is read of the result further on never parses again."""
    text = F.col(body)

    def judged(outer: Column, message: Column, inner: Column, records: Column) -> Column:
        rec = F.coalesce(records, F.array())
        unnamed = F.exists(rec, lambda r: r["s3"]["bucket"]["name"].isNull() | r["s3"]["object"]["key"].isNull())
        day = F.exists(rec, lambda r: F.substring(r["eventTime"], 1, 10).try_cast("date").isNull()
                       | ~F.coalesce(r["eventTime"].rlike(r"^\d{4}-\d{2}-\d{2}"), F.lit(False)))
        is_json = F.coalesce(outer.isNotNull() & text.rlike(r"^\s*\{") & (message.isNull() | inner.isNotNull()), F.lit(False))
        fault = F.when(~is_json, "malformed notification").when(unnamed, "record without bucket or key").when(day, "record without a date")
        return F.struct(records.alias("records"), fault.alias("fault"))

    def of_event(outer: Column, message: Column, inner: Column) -> Column:
        event = F.when(message.isNotNull(), inner).otherwise(outer)
        return _bound(F.try_variant_get(event, "$.Records", RECORDS), lambda records: judged(outer, message, inner, records))

    def of_body(outer: Column) -> Column:
        return _bound(F.try_variant_get(outer, "$.Message", "string"),
                      lambda message: _bound(F.try_parse_json(message), lambda inner: of_event(outer, message, inner)))

    parsed = F.transform(F.array(F.try_parse_json(text)), of_body)
    # a generator's output is computed before any filter on it
    return messages.select("*", F.explode(parsed).alias("_parsed")).select(*messages.columns, "_parsed.records", "_parsed.fault")


def _parsed(messages: DataFrame, body: str) -> DataFrame:
    return messages if {"records", "fault"} <= set(messages.columns) else parse(messages, body)


def named(rec: Column) -> list[Column]:
    """Bucket, decoded key and event date of a record."""
    return [rec["s3"]["bucket"]["name"].alias("bucket"), decoded_key(rec["s3"]["object"]["key"]).alias("key"),
            F.substring(rec["eventTime"], 1, 10).alias("processing_date")]


def flatten(messages: DataFrame, id_col: str = "message_id", body: str = "body") -> DataFrame:
    """One row per record of the good messages: message id, bucket, decoded key, event date."""
    good = _parsed(messages, body).filter(F.col("fault").isNull())
    return good.select(id_col, F.explode("records").alias("r")).select(id_col, *named(F.col("r")))


def quarantine(messages: DataFrame, id_col: str = "message_id", body: str = "body") -> DataFrame:
    """Messages set aside, whole and with the reason; one bad message never fails the others."""
    return _parsed(messages, body).filter(F.col("fault").isNotNull()).select(id_col, body, F.col("fault").alias("reject_reason"))


def outcomes(messages: DataFrame, id_col: str = "message_id", body: str = "body") -> DataFrame:
    """``flatten`` and ``quarantine`` in one pass: the records of good messages, and one row of each bad message with
    its ``reject_reason``. Messages without anything to do give nothing."""
    none = F.array(F.lit(None).cast(RECORDS.removeprefix("array<").removesuffix(">")))
    rows = _parsed(messages, body).select(id_col, "fault", F.explode(F.when(F.col("fault").isNull(), F.col("records")).otherwise(none)).alias("r"))
    return rows.select(id_col, *named(F.col("r")), F.col("fault").alias("reject_reason"))


def receive_outcomes(receives: DataFrame, max_receives: int = 3, id_col: str = "message_id", at: str = "received_at",
                     seq: str = "receive_id", ok: str = "ok") -> DataFrame:
    """What became of every message: ``id, status, receives, decided_at``.

    A message is received until it succeeds (``done``) or has failed ``max_receives`` times (``dead``, for the
    dead letters); else it is ``waiting``. Receives after that don't count. Of a message's failures only the
    first ``max_receives`` leave a map task, so one that is received without end is no hot key.
    """
    when = F.struct(F.col(at).alias("at"), F.col(seq).alias("seq"))
    nth = F.row_number().over(Window.partitionBy(id_col).orderBy(at, seq))
    failed = (receives.filter(~F.coalesce(F.col(ok), F.lit(False))).withColumn("_n", nth).filter(F.col("_n") <= max_receives)
              .groupBy(id_col).agg(F.sort_array(F.collect_list(when)).alias("failed")))
    worked = receives.filter(F.col(ok)).groupBy(id_col).agg(F.min(when).alias("worked"))
    both = failed.join(worked, id_col, "full").withColumn("failed", F.coalesce("failed", F.array().cast(failed.schema["failed"].dataType)))
    last = F.get("failed", F.lit(max_receives - 1))
    dead = last.isNotNull() & (F.col("worked").isNull() | (last < F.col("worked")))
    tried = F.size(F.filter("failed", lambda f: f < F.col("worked")))
    return both.select(
        id_col, F.when(dead, "dead").when(F.col("worked").isNotNull(), "done").otherwise("waiting").alias("status"),
        F.when(dead, F.lit(max_receives)).when(F.col("worked").isNotNull(), tried + 1).otherwise(F.size("failed")).cast("long").alias("receives"),
        F.when(dead, last["at"]).otherwise(F.col("worked.at")).alias("decided_at"))
