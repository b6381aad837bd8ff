"""Structured Streaming ingestion of file arrivals.

* ``ratings_files``: a JSON file source over a landing prefix (declared schema; lineage column from
  ``_metadata.file_path``). ``trigger(availableNow=True)`` processes whatever arrived since the last
  checkpoint and stops, which is how a file-arrival event starts the batch pipeline.
* ``start_ratings_ingest``: ``foreachBatch`` runs the batch operators on each micro-batch and merges
  the result into the mutable tables. A replayed epoch (after an executor or driver loss) re-merges
  the same rows, and the unconditional / latest-wins merges are idempotent for that.
* ``dedupe_stream``: duplicate events inside a watermark, with bounded state.
* ``announced_files``: a stream of announcements joined with the stream of files that they name; a file that
  does not come in time is a row of its own.
* ``count_receives``: how often a message was received, kept as keyed state until it worked or is a dead letter.
* ``start_notification_ingest``: queue message bodies as text files; parsed records and quarantined
  messages go to separate sinks from the same micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StringType, StructField, StructType

from daybook.sources import notifications
from daybook.sources.files import whole_json_files
from daybook.spec import RATING_KEYS

LANDED_RATING_SCHEMA = StructType([
    StructField("customerNumber", StringType()),
    StructField("productCode", StringType()),
    StructField("productRating", StringType()),
    StructField("ratingTimestamp", StringType()),
])


def ratings_files(spark: SparkSession, landing_dir: str, schema: StructType = LANDED_RATING_SCHEMA,
                  max_files_per_trigger: int | None = 1000) -> DataFrame:
    """The objects of the files that arrive; at most so many files in one micro-batch, however many wait."""
    reader = spark.readStream.schema(schema).option("multiLine", True).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.json(landing_dir)
            .withColumn("source", F.col("_metadata.file_path"))
            .withColumn("ingest_ts", F.current_timestamp()))


def start_ratings_ingest(stream: DataFrame, handle_batch: Callable[[DataFrame, int], None], checkpoint: str,
                         available_now: bool = True) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def dedupe_stream(events: DataFrame, event_time: str = "ingest_ts", delay: str = "1 day",
                  keys=RATING_KEYS) -> DataFrame:
    """Drop repeated events that arrive within ``delay`` of each other (state is bounded by the
    watermark, unlike an unbounded ``dropDuplicates``)."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def message_files(spark: SparkSession, inbox_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One queue message body per line of the files arriving in ``inbox_dir``, with the time of its file."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.text(inbox_dir)
            .select(F.concat(F.col("_metadata.file_name"), F.lit(":"), F.xxhash64("value").cast("string"))
                    .alias("message_id"), F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias("announced_at")))


def _path(location: Column) -> Column:
    """A file's path as text: blanks and other signs decoded, one slash after the scheme."""
    decoded = F.coalesce(F.try_url_decode(F.replace(location, F.lit("+"), F.lit("%2B"))), location)
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def announced_files(spark: SparkSession, messages: DataFrame, incoming: str, wait: str = "1 day",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of ``message_id, bucket, key, processing_date, reject_reason, source, content``.

    ``messages`` (``message_files``) are parsed and joined with the files that arrive in ``incoming``, on the
    path that the message names. Neither file names nor counts come to the driver, and a file is read once,
    when it arrives. A message whose file has not arrived ``wait`` after it (by the files' times) comes with
    a null ``source``; a bad message comes at once with its ``reject_reason``. A message that is delivered again within
    ``wait`` is dropped. The state holds what still waits for its other side, ``wait`` long.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(incoming)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    parsed = notifications.parse(dedupe_stream(messages, "announced_at", wait, ("body",)))
    bad = notifications.outcomes(parsed.filter(F.col("fault").isNotNull()))
    rows = parsed.filter(F.col("fault").isNull()).select("message_id", "announced_at", F.explode("records").alias("r"))
    named = rows.select("message_id", "announced_at", *notifications.named(F.col("r"))).withColumn(
        "path", F.concat(_path(F.lit(root)), F.lit("/"), F.ltrim(F.col("key"), F.lit("/")))).alias("n")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = whole_json_files(reader, incoming).withWatermark("file_time", wait).withColumn("path", _path(F.col("source"))).alias("f")
    within = F.expr(f"f.file_time between n.announced_at - interval {wait} and n.announced_at + interval {wait}")
    joined = named.join(files, (F.col("n.path") == F.col("f.path")) & within, "left_outer").select(
        "message_id", "bucket", "key", "processing_date", F.lit(None).cast("string").alias("reject_reason"), "source", "content")
    none = F.lit(None).cast("string")
    return joined.unionByName(bad.select("message_id", "bucket", "key", "processing_date", "reject_reason", none.alias("source"), none.alias("content")))


def count_receives(receives: DataFrame, max_receives: int = 3, ttl: str = "14 days") -> DataFrame:
    """A stream of receives (``message_id, receive_id, received_at, ok``) -> ``message_id, status, receives,
    decided_at`` of every message when it is decided: ``done``, or ``dead`` after ``max_receives`` failures
    (``notifications.receive_outcomes`` is the same over a table).

    A message's failures are keyed state, which lives ``ttl`` after its last receive by the receives' own times (one that
    comes later than that after the newest is no longer counted); a decided message stays known
    that long, so that a later receive of it changes nothing. A rerun of a failed batch counts nothing twice: state and
    offsets are committed together.
    """
    n, unit = ttl.split()
    ttl_ms = int(n) * {"minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]

    def count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        failed, decided = state.get if state.exists else (0, False)
        rows = pd.concat(list(batches)).sort_values(["received_at", "receive_id"])
        for r in rows.itertuples():
            if decided:
                break
            ok = r.ok is not None and bool(r.ok)
            failed += not ok
            decided = ok or failed == max_receives
            if decided:
                yield pd.DataFrame({"message_id": [key[0]], "status": ["done" if ok else "dead"], "receives": [failed + ok], "decided_at": [r.received_at]})
        state.update((failed, decided))
        state.setTimeoutTimestamp(int(rows["ms"].max()) + ttl_ms)

    seen = receives.select("message_id", "receive_id", "received_at", "ok", F.unix_millis("received_at").alias("ms")).withWatermark("received_at", ttl)
    return seen.groupBy("message_id").applyInPandasWithState(
        count, "message_id string, status string, receives long, decided_at timestamp", "failed int, decided boolean", "append",
        GroupStateTimeout.EventTimeTimeout)


def start_notification_ingest(messages: DataFrame, records_path: str, quarantine_path: str, checkpoint: str
                              ) -> StreamingQuery:
    def handle(batch: DataFrame, epoch: int) -> None:
        # One micro-batch feeds two sinks: persist it so the source files are read once. Each
        # epoch replaces its own directory, so a replayed epoch does not append twice.
        batch = notifications.parse(batch).persist()
        try:
            notifications.flatten(batch).write.mode("overwrite").parquet(f"{records_path}/epoch={epoch}")
            notifications.quarantine(batch).write.mode("overwrite").parquet(f"{quarantine_path}/epoch={epoch}")
        finally:
            batch.unpersist()

    return (messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
