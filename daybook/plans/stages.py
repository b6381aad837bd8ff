"""The daily run as stage functions over a lake root (landing -> curated -> gate -> star -> presentation).

Stages pass data only through written tables, so any stage can be rerun alone for a day; every
write replaces whole partitions, so reruns and retried tasks are idempotent. Every stage returns the
counts that the audit records.
"""

from __future__ import annotations

import contextvars
import functools
import uuid
import zlib
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daybook import fixed_values as FV
from daybook.context import RunContext, configure_session
from daybook.operators.audit import Audit
from daybook.operators.dedupe import latest_by
from daybook.operators.quality import curated_checks, gate, model_gate, model_tests
from daybook.operators.routing import known_keys
from daybook.operators.typing import add_curated_metadata, add_ingest_metadata, conform, type_ratings
from daybook.operators.validate import validate
from daybook.plans import marts, masters, presentation, ratings, staging, star
from daybook.plans.curation import curate
from daybook.sinks.tables import (PartitionedTable, insert_overwrite_partition, listed, path_exists, remove_folder,
                                  replace_table, wider_type, write_landing_csv, write_rejects)
from daybook.sources.files import (MALFORMED_FILE, catalog_table, day_window_scan, json_file_rows, read_landed_csv, read_landed_json,
                                   register_external, whole_json_files)
from daybook.spec import RATING_KEYS, RATING_PAIR, RATING_RULES, RATINGS_FOR_ML_SCHEMA, RATINGS_SCHEMA, SPECS
from daybook.streaming.ingest import LANDED_RATING_SCHEMA


@dataclass(frozen=True)
class Lake:
    """Zone layout under one shared root (object store or HDFS path).

    ``schema`` is the catalog schema of the curated tables; ``model_schemas`` names another one per
    model (see ``model_schema``), whose folder the model then has.
    """

    root: str
    schema: str | None = None
    model_schemas: tuple[tuple[str, str], ...] = ()

    def landing(self, source: str, table: str, day: str) -> str:
        return f"{self.root}/landing_zone/{source}/{table}/processing_date={day}"

    def curated(self, table: str) -> str:
        return f"{self.root}/curated_zone/{table}"

    def catalog(self, table: str) -> str:
        """Catalog name of a curated table; without a schema of its own a lake gets one by its root."""
        return f"{self.schema or f'lake_{zlib.crc32(self.root.encode()):08x}'}.curated_{table}"

    def lakehouse(self, table: str) -> str:
        return f"{self.root}/lakehouse/{table}"

    def models(self, name: str) -> str:
        return f"{self.root}/{model_schema('models', dict(self.model_schemas).get(name))}/{name}"

    def presentation(self, name: str) -> str:
        return f"{self.root}/presentation_zone/{name}"

    def staging(self, name: str) -> str:
        return f"{self.root}/_staging/{name}-{uuid.uuid4().hex[:12]}"

    def quality(self, ctx: RunContext, kind: str = "checks") -> str:
        return f"{self.root}/quality_results/{kind}/processing_date={ctx.processing_date}/run_id={ctx.run_id}"


def model_schema(default_schema: str, custom_schema: str | None = None) -> str:
    """Target schema of a model: a custom schema name is used as given, otherwise the default."""
    return custom_schema.strip() if custom_schema else default_schema


def _curated_table(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """A curated table through the catalog, with every column any of its days brought.

    A session whose catalog does not know it (one that is not persistent) registers the files first, with the
    columns of all days, each in the widest of its days' types: one footer is read for each day.
    """
    name = lake.catalog(table)
    if not spark.catalog.tableExists(name):
        fields: dict[str, StructField] = {}
        for day in sorted(listed(spark, lake.curated(table), folders=True)):
            if day.startswith("processing_date=") and listed(spark, f"{lake.curated(table)}/{day}", folders=False):
                for f in spark.read.parquet(f"{lake.curated(table)}/{day}").schema.fields:
                    known = fields.get(f.name)
                    fields[f.name] = f if known is None else StructField(f.name, wider_type(known.dataType, f.dataType))
        _register(spark, lake, table, StructType(list(fields.values())))
    return catalog_table(spark, name)


def _register(spark: SparkSession, lake: Lake, table: str, schema: StructType) -> None:
    name = lake.catalog(table)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")
    fields = [f for f in schema.fields if f.name != "processing_date"] + [StructField("processing_date", StringType())]
    register_external(spark, name, lake.curated(table), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields),
                      "processing_date")


def write_curated(spark: SparkSession, lake: Lake, table: str, df: DataFrame, day: str, ctx: RunContext | None = None) -> int:
    """Replace one day of a curated table; columns that are new to the table are added to it, stored types are
    widened where the day's values need it. Rows with a value that fits no such type go to the run's rejects
    (``<table>_types``) and are counted; without a run they fail the write."""
    rejected = 0

    def set_aside(rows: DataFrame) -> None:
        nonlocal rejected
        rejected = write_rejects(rows, lake.root, f"{table}_types", ctx)

    name = lake.catalog(table)
    if not spark.catalog.tableExists(name):
        if path_exists(spark, lake.curated(table)):
            _curated_table(spark, lake, table)
        else:
            _register(spark, lake, table, df.schema)
    insert_overwrite_partition(spark, df, name, "processing_date", day, set_aside if ctx else None)
    if table in masters.MASTER_KEYS:
        curated = _curated_table(spark, lake, table)
        masters.refresh_master(masters.master_table(spark, lake.lakehouse(f"master_{table}"), curated.schema, masters.MASTER_KEYS[table]),
                               curated, masters.MASTER_KEYS[table], day)
    return rejected


def _master(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The newest row of every key of a curated table: its kept state, or (files that no stage wrote) all its days."""
    curated = _curated_table(spark, lake, table)
    kept = masters.master_table(spark, lake.lakehouse(f"master_{table}"), curated.schema, masters.MASTER_KEYS[table]).read()
    return curated if kept is None else kept


def ratings_for_ml_table(spark: SparkSession, lake: Lake) -> PartitionedTable:
    """Rating events, partitioned by day; a key's rating time tells which days can hold it."""
    return PartitionedTable(spark, lake.lakehouse("ratings_for_ml"), RATINGS_FOR_ML_SCHEMA, "processing_date", zone=["ratingTimestamp"])


def ratings_state_table(spark: SparkSession, lake: Lake, buckets: int = 256) -> PartitionedTable:
    """Newest rating per pair, partitioned by a hash bucket of the pair."""
    return PartitionedTable(spark, lake.lakehouse("ratings"), RATINGS_SCHEMA, "bucket",
                            by=F.pmod(F.xxhash64(*RATING_PAIR), F.lit(buckets)), of_keys=True)


def model_table(spark: SparkSession, lake: Lake, name: str, schema: StructType, key: str) -> PartitionedTable:
    """Facts by month of the order or rating, dimensions by a hash bucket of their key. A rating's key holds its
    time (and so its month)."""
    if name == "fact_order_items":
        return star.fact_order_items_table(spark, lake.models(name), schema)
    if name == "fact_product_ratings":
        return PartitionedTable(spark, lake.models(name), schema, "rating_month", by=F.date_format("rating_timestamp", "yyyy-MM"), of_keys=True)
    return PartitionedTable(spark, lake.models(name), schema, "bucket", by=F.pmod(F.xxhash64(key), F.lit(64)), of_keys=True)


#: Staged tables of the stage that runs.
_STAGED: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("staged", default=None)


def _staged(df: DataFrame, lake: Lake, name: str) -> DataFrame:
    """Evaluate a merge source once: written to the lake's staging area and read back. The stage that stages
    it removes it when it ends (``clears_staging``)."""
    path = lake.staging(name)
    if (paths := _STAGED.get()) is not None:
        paths.append(path)
    return replace_table(df, path)


def clears_staging(stage):
    """The stage's staged tables go when it ends, well or not: a rerun stages its own."""

    @functools.wraps(stage)
    def run(spark: SparkSession, *args, **kw):
        paths: list[str] = []
        token = _STAGED.set(paths)
        try:
            return stage(spark, *args, **kw)
        finally:
            _STAGED.reset(token)
            for p in paths:
                remove_folder(spark, p)

    return run


# ------------------------------------------------------------------ landing ---------------

def land_relational(spark: SparkSession, ctx: RunContext, lake: Lake, sources: dict[str, DataFrame],
                    updated_at: str = "updated_at", snapshots: tuple[str, ...] = ()) -> dict:
    """Rows changed on the day (half-open window, pushed to the source) -> landing CSV, all text.

    A table without ``updated_at`` is an error unless it is named in ``snapshots``: those land whole.
    """
    total = 0
    for table, df in sources.items():
        if table in snapshots:
            day = df
        elif updated_at in df.columns:
            day = day_window_scan(df, updated_at, ctx)
        else:
            raise ValueError(f"{table}: no column {updated_at!r}; name the table in snapshots to land it whole")
        out = add_ingest_metadata(day, ctx, FV.SOURCE_DATABASE)
        obs = Observation(f"landed_{table}")
        out = out.select(*[F.col(c).cast("string").alias(c) for c in out.columns]).observe(
            obs, F.count(F.lit(1)).alias("n"))
        write_landing_csv(out, lake.landing("rds", table, ctx.processing_date))
        total += int(obs.get["n"])
    return {"table_count": len(sources), "row_count": total}


def land_ratings(spark: SparkSession, ctx: RunContext, lake: Lake, source_dir: str) -> dict:
    """Multi-line JSON files of the day -> landing JSON lines with lineage columns. A file that is no JSON goes
    to the rejects (``ratings_files``) whole, and is counted."""
    rows = json_file_rows(whole_json_files(spark.read, source_dir).drop("file_time"), LANDED_RATING_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        broken = rows.filter(F.col("_broken").isNotNull())
        rejected = write_rejects(broken.select("source", F.col("_broken").alias("content"), F.lit(MALFORMED_FILE).alias("reject_reason")),
                                 lake.root, "ratings_files", ctx)
        obs = Observation("landed_ratings")
        landed = rows.filter(F.col("_broken").isNull()).drop("_broken")
        out = add_ingest_metadata(landed, ctx, F.col("source")).observe(obs, F.count(F.lit(1)).alias("n"))
        out.write.mode("overwrite").json(lake.landing("json", "ratings", ctx.processing_date))
        return {"row_count": int(obs.get["n"]), "rejected_rows": rejected}
    finally:
        rows.unpersist()


# ------------------------------------------------------------------ curation --------------

def transform_relational(spark: SparkSession, ctx: RunContext, lake: Lake, tables=tuple(SPECS)) -> dict:
    """Landing CSV -> typed, validated, deduplicated curated partition + rejects of the run."""
    totals = {"valid_rows": 0, "rejected_rows": 0}
    for table in tables:
        spec = SPECS[table]
        # The rejects write and the curated write both derive from the day's landed rows: keep the
        # parsed rows (columnar, spilling to disk) instead of parsing the CSV for each output. A
        # lost executor recomputes its blocks from the landing files.
        landed = conform(read_landed_csv(spark, lake.landing("rds", table, ctx.processing_date)), spec) \
            .drop("processing_date").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            batch = curate(landed, spec, per_batch=False)
            totals["rejected_rows"] += write_rejects(batch.rejected(), lake.root, table, ctx)
            obs = Observation(f"curated_{table}")
            curated = add_curated_metadata(batch.valid, ctx).observe(obs, F.count(F.lit(1)).alias("n"))
            misfits = write_curated(spark, lake, table, curated, ctx.processing_date, ctx)
            totals["valid_rows"] += int(obs.get["n"]) - misfits
            totals["rejected_rows"] += misfits
        finally:
            landed.unpersist()
    return totals


@clears_staging
def _transform_events(spark: SparkSession, ctx: RunContext, lake: Lake, landed: DataFrame, day: str | None) -> dict:
    """Typed and validated once, deduplicated and routed once: both steps are staged as tables, and the
    rejects and the merge both read the second."""
    tagged = _staged(validate(type_ratings(landed, day), RATING_RULES, mode="first"), lake, "typed_ratings")
    staged = _staged(ratings.outcome(tagged, _master(spark, lake, "customers"), _master(spark, lake, "products")),
                     lake, "ratings")
    rejected = write_rejects(staged.filter(F.col("reject_reason").isNotNull()).drop("productName", "productLine"), lake.root, "ratings", ctx, stamp=False)
    obs = Observation("known_ratings")
    known = ratings.to_ratings_for_ml(staged.filter(F.col("reject_reason").isNull()), ctx.now())
    if day is None:
        known = latest_by(known, list(RATING_KEYS), ["processing_date", "ingest_ts"])
    known = _staged(known.observe(obs, F.count(F.lit(1)).alias("n")), lake, "known_ratings")
    # unique on the event key: the events of one day by the dedupe, those of several days by their newest
    ratings_for_ml_table(spark, lake).merge(known, list(RATING_KEYS), check_unique=False)
    return {"valid_rows": int(obs.get["n"]), "rejected_rows": rejected}


def transform_ratings(spark: SparkSession, ctx: RunContext, lake: Lake) -> dict:
    """Landing JSON -> validated, deduplicated, routed events merged into ``ratings_for_ml``."""
    schema = StructType(LANDED_RATING_SCHEMA.fields + [StructField(c, StringType()) for c in ("ingest_ts", "source", "run_id")])
    landed = read_landed_json(spark, lake.landing("json", "ratings", ctx.processing_date), schema)
    return _transform_events(spark, ctx, lake, landed, ctx.processing_date)


@clears_staging
def merge_ratings(spark: SparkSession, ctx: RunContext, lake: Lake) -> dict:
    """Newest rating per pair of the day -> conditional merge into the current-state ``ratings``."""
    rfml = ratings_for_ml_table(spark, lake).read()
    latest = ratings.latest_per_pair(rfml.filter(F.col("processing_date") == ctx.processing_date))
    obs = Observation("merged_ratings")
    latest = _staged(latest.observe(obs, F.count(F.lit(1)).alias("n")), lake, "latest_ratings")
    ratings_state_table(spark, lake).merge(latest, list(RATING_PAIR), ratings.latest_wins("ratingTimestamp"), check_unique=False)
    return {"merged_rows": int(obs.get["n"])}


# ------------------------------------------------------------------ gate ------------------

class GateFailure(RuntimeError):
    """A failed gate, with the counts of all its checks."""

    def __init__(self, cause: Exception, metrics: dict):
        super().__init__(str(cause))
        self.metrics = metrics


def quality_gate(spark: SparkSession, ctx: RunContext, lake: Lake) -> dict:
    """Seven checks in one small result; results are written first, then the gate raises."""
    day = F.col("processing_date") == ctx.processing_date
    cur = {t: _curated_table(spark, lake, t) for t in ("customers", "products", "orders", "orderdetails")}
    results = curated_checks(
        cur["customers"].filter(day), cur["products"].filter(day), cur["orders"].filter(day), cur["orderdetails"].filter(day),
        ratings_for_ml_table(spark, lake).read().filter(day),
        known_keys(cur["customers"], "customerNumber", ctx.processing_date),
        known_keys(cur["products"], "productCode", ctx.processing_date), ctx.run_id, ctx.processing_date)
    results.coalesce(1).write.mode("overwrite").json(lake.quality(ctx))
    written = spark.read.schema(results.schema).json(lake.quality(ctx))
    counts = {r.check_name: r.failure_count for r in written.collect()}  # one row per check
    metrics = {"check_count": len(counts), "failed_checks": sum(n > 0 for n in counts.values()), **counts}
    try:
        gate(written)
    except Exception as exc:
        raise GateFailure(exc, metrics) from exc
    return metrics


# ------------------------------------------------------------------ models ----------------

MODEL_KEYS = {"dim_customers": "customer_number", "dim_products": "product_code", "fact_order_items": "order_item_id",
              "fact_product_ratings": "rating_id"}


@clears_staging
def build_star(spark: SparkSession, ctx: RunContext, lake: Lake, full_refresh: bool = False) -> dict:
    """Staging views -> incremental dims and facts (merge on the unique key) -> dim_date -> marts, then
    the declared model tests over the written models; a failing test fails the stage once its results are
    stored. ``full_refresh`` rebuilds every model from all of history."""
    cur = {t: _curated_table(spark, lake, t) for t in ("customers", "products", "orders", "orderdetails")}
    rfml = ratings_for_ml_table(spark, lake).read()
    day = ctx.processing_date

    def full(name: str) -> DataFrame:
        if name == "dim_customers":
            return star.dim_customers(staging.stg_customers(cur["customers"]))
        if name == "dim_products":
            return star.dim_products(staging.stg_products(cur["products"]))
        if name == "fact_order_items":
            return star.fact_order_items_of(cur["orderdetails"], cur["orders"])
        return star.fact_product_ratings(staging.stg_ratings(rfml))

    def fresh(name: str) -> DataFrame:
        if name == "dim_customers":
            return star.dim_slice(cur["customers"], "customerNumber", day, staging.stg_customers, star.dim_customers)
        if name == "dim_products":
            return star.dim_slice(cur["products"], "productCode", day, staging.stg_products, star.dim_products)
        if name == "fact_order_items":
            return star.fact_order_items_slice(cur["orderdetails"], cur["orders"], day)
        return star.fact_product_ratings_slice(rfml, day)

    out, merged, changed, tables = {}, 0, {}, {}
    for name, key in MODEL_KEYS.items():
        whole = full(name).withColumn(FV.MODEL_BUILD_TS_COLUMN, ctx.now())
        table = model_table(spark, lake, name, whole.schema, key)
        if full_refresh or not table.exists():
            table.replace(whole, [key])
        else:
            # slices are unique on the model key by construction: no duplicate-source check
            obs = Observation(f"merged_{name}")
            part = fresh(name).withColumn(FV.MODEL_BUILD_TS_COLUMN, ctx.now()).observe(obs, F.count(F.lit(1)).alias("n"))
            changed[name] = table.merge(_staged(part.drop(*table.derived), lake, name), [key], check_unique=False)
            merged += int(obs.get["n"])
        out[name], tables[name] = table.read(), table
    out["dim_date"] = replace_table(star.dim_date(out["fact_order_items"]), lake.models("dim_date"))
    # the marts are brought up to date from the months whose facts were rewritten
    items, rated = tables["fact_order_items"], tables["fact_product_ratings"]
    months, rating_months = changed.get("fact_order_items"), changed.get("fact_product_ratings")
    marts.refresh_months(marts.sales_table(spark, lake.models("mart_monthly_sales")), items, marts.mart_monthly_sales, months)
    sold = marts.refresh_months(marts.product_months_table(spark, lake.models("product_months")), items, marts.product_months, months)
    stars = marts.refresh_months(marts.rating_months_table(spark, lake.models("rating_months")), rated, marts.rating_months, rating_months)
    replace_table(marts.product_performance(out["dim_products"], sold, stars), lake.models("mart_product_performance"))
    register_views(spark, lake)
    results = model_tests(out)
    results.coalesce(1).write.mode("overwrite").json(lake.quality(ctx, "models"))
    written = spark.read.schema(results.schema).json(lake.quality(ctx, "models"))
    failed = written.filter(F.col("failures") > 0).count()
    metrics = {"model_count": len(out) + 2, "merged_rows": merged, "test_count": written.count(), "failed_tests": failed}
    try:
        model_gate(written)
    except Exception as exc:
        raise GateFailure(exc, metrics) from exc
    return metrics


def refresh_presentation(spark: SparkSession, ctx: RunContext, lake: Lake) -> dict:
    """Four presentation tables, each replaced as a whole."""
    rfml = ratings_for_ml_table(spark, lake).read()
    outputs = {
        "ratings": presentation.presentation_ratings(ratings_state_table(spark, lake).read()),
        "ratings_for_ml": presentation.presentation_ratings_for_ml(rfml),
        "sales_report": presentation.sales_report(_curated_table(spark, lake, "orders"),
                                                  _curated_table(spark, lake, "orderdetails")),
        "ratings_per_product": presentation.ratings_per_product(_curated_table(spark, lake, "products"), rfml),
    }
    rows = 0
    for name, df in outputs.items():
        obs = Observation(f"presented_{name}")
        replace_table(df.observe(obs, F.count(F.lit(1)).alias("n")), lake.presentation(name))
        rows += int(obs.get["n"])
    return {"table_count": len(outputs), "row_count": rows}


def run_pipeline(spark: SparkSession, ctx: RunContext, lake: Lake, sources: dict[str, DataFrame],
                 ratings_dir: str, audit_table: str = "daybook_audit", snapshots: tuple[str, ...] = (),
                 full_refresh: bool = False) -> None:
    """All stages of one day in order; each stage's start, end, failure and counts are audited, and the
    run's status at its end. ``ctx.run_mode`` only goes to the audit; a backfill is an old date."""
    configure_session(spark)
    audit = Audit(spark, audit_table, ctx.run_id)
    steps = [
        (FV.STAGE_DATABASE_LANDING, lambda: land_relational(spark, ctx, lake, sources, snapshots=snapshots)),
        (FV.STAGE_RATINGS_LANDING, lambda: land_ratings(spark, ctx, lake, ratings_dir)),
        (FV.STAGE_RELATIONAL_TRANSFORM, lambda: transform_relational(spark, ctx, lake, tuple(sources))),
        (FV.STAGE_RATINGS_TRANSFORM, lambda: transform_ratings(spark, ctx, lake)),
        (FV.STAGE_RATINGS_MERGE, lambda: merge_ratings(spark, ctx, lake)),
        (FV.STAGE_QUALITY, lambda: quality_gate(spark, ctx, lake)),
        ("presentation", lambda: refresh_presentation(spark, ctx, lake)),
        ("models", lambda: build_star(spark, ctx, lake, full_refresh)),
    ]
    run = {"processing_date": ctx.processing_date, "run_mode": ctx.run_mode}
    try:
        for stage, fn in steps:
            audit.start(stage)
            try:
                metrics = fn()
            except Exception as exc:
                audit.fail(stage, exc, {**run, **getattr(exc, "metrics", {})})
                raise
            status = FV.STATUS_SUCCEEDED_WITH_REJECTS if metrics.get("rejected_rows") else FV.STATUS_SUCCEEDED
            audit.succeed(stage, status, {**run, **metrics})
    finally:
        audit.finish()


def stream_ratings(spark: SparkSession, ctx: RunContext, lake: Lake, inbox_dir: str, checkpoint: str,
                   available_now: bool = True):
    """File-arrival ingestion of rating files straight into ``ratings_for_ml``.

    A file in a folder ``processing_date=<day>`` of the inbox has that day, any other the run's. Each
    micro-batch is read once, then typed, validated, deduplicated and routed like a daily batch. A
    replayed epoch (after a failure) re-merges the same rows: the MERGE is idempotent.
    """
    from daybook.streaming.ingest import ratings_files, start_ratings_ingest

    def handle(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            epoch_ctx = RunContext(ctx.processing_date, f"{ctx.run_id}-e{epoch}", ctx.run_mode, ctx.run_ts)
            _transform_events(spark, epoch_ctx, lake, batch, None)
        finally:
            batch.unpersist()

    folder = F.regexp_extract("source", r"/processing_date=(\d{4}-\d{2}-\d{2})/", 1)
    files = ratings_files(spark, inbox_dir).withColumn(
        "processing_date", F.coalesce(F.nullif(folder, F.lit("")), F.lit(ctx.processing_date)))
    return start_ratings_ingest(files, handle, checkpoint, available_now)


def stream_arrivals(spark: SparkSession, ctx: RunContext, lake: Lake, queue_dir: str, incoming: str, checkpoint: str,
                    wait: str = "1 day", max_files_per_trigger: int = 1000):
    """Arrival notifications start the ingestion of the files they name, each with its own event's day.

    The announcements are joined with the files that arrive (``announced_files``); nothing of either comes to
    the driver. Each micro-batch sets
    aside, per epoch under ``quarantine/``: bad messages, announcements whose file did not come in time
    (``missing_files``) and files that are no JSON, whole (``files``); everything else is ingested. One bad message or
    file holds nothing up.
    """
    from daybook.streaming.ingest import announced_files, message_files

    def handle(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            def set_aside(rows: DataFrame, kind: str) -> None:
                rows.write.mode("overwrite").parquet(f"{lake.root}/quarantine/{kind}/run_id={ctx.run_id}/epoch={epoch}")

            good = F.col("reject_reason").isNull()
            set_aside(batch.filter(~good).select("message_id", "reject_reason"), "notifications")
            set_aside(batch.filter(good & F.col("source").isNull()).select("message_id", "bucket", "key", "processing_date"), "missing_files")
            found = batch.filter(good & F.col("source").isNotNull()).select("source", "processing_date", "content")
            rows = json_file_rows(found, LANDED_RATING_SCHEMA).withColumn("ingest_ts", ctx.now())
            set_aside(rows.filter(F.col("_broken").isNotNull()).select("source", "processing_date", "_broken"), "files")
            epoch_ctx = RunContext(ctx.processing_date, f"{ctx.run_id}-e{epoch}", ctx.run_mode, ctx.run_ts)
            _transform_events(spark, epoch_ctx, lake, rows.filter(F.col("_broken").isNull()).drop("_broken"), None)
        finally:
            batch.unpersist()

    messages = message_files(spark, queue_dir, max_files_per_trigger)
    return (announced_files(spark, messages, incoming, wait, max_files_per_trigger).writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


CURATED_SOURCES = ("customers", "employees", "offices", "orderdetails", "orders", "payments", "productlines",
                   "products")


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Declared sources and staging views as temp views (``curated_<table>``, ``stg_<name>``), so
    SQL users can query them by name; each is a lazy plan over the written tables."""
    names = []
    for table in CURATED_SOURCES:
        if path_exists(spark, lake.curated(table)):
            _curated_table(spark, lake, table).createOrReplaceTempView(f"curated_{table}")
            names.append(f"curated_{table}")
    stagers = {"customers": staging.stg_customers, "products": staging.stg_products,
               "orders": staging.stg_orders, "orderdetails": staging.stg_orderdetails}
    for table, fn in stagers.items():
        if f"curated_{table}" in names:
            fn(spark.table(f"curated_{table}")).createOrReplaceTempView(f"stg_{table}")
            names.append(f"stg_{table}")
    rfml = ratings_for_ml_table(spark, lake).read()
    if rfml is not None:
        rfml.createOrReplaceTempView("curated_ratings_for_ml")
        staging.stg_ratings(rfml).createOrReplaceTempView("stg_ratings")
        names += ["curated_ratings_for_ml", "stg_ratings"]
    return names
