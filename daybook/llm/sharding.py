"""Size-balanced shards from sampled splitters (DataFrame functions only).

Records are ordered by a 64-bit key (hash of the text, then hash of the id). A size- and
row-weighted sample of keys gives quantile splitters; they cut the key space into many ranges of
near-equal load, ranges that are still overfull (a hot key, an unlucky sample) are subdivided by
splitters from a denser sample of just their records, and the exact load of every range plus a running
sum inside it places each record on the 0..total line of bytes, which is cut into equal shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.shared import materialise

LOWEST = -(1 << 63)


def _range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below the record's (key, tie): binary search in a literal array."""
    if not splitters:
        return F.lit(0)
    keys, ties = F.lit([k for k, _ in splitters]), F.lit([t for _, t in splitters])
    steps = [1 << i for i in range(len(splitters).bit_length() - 1, -1, -1)]

    def step(pos: Column, jump: Column) -> Column:
        at = pos + jump
        k = F.element_at(keys, F.least(at, F.lit(len(splitters))))
        t = F.element_at(ties, F.least(at, F.lit(len(splitters))))
        below = (k < F.col("key")) | ((k == F.col("key")) & (t <= F.col("tie")))
        return F.when((at <= len(splitters)) & below, at).otherwise(pos)

    return F.aggregate(F.lit(steps), F.lit(0), step)


def _sampled(rows: DataFrame, want: float, total_bytes: int, total_rows: int, seed: int) -> DataFrame:
    """Poisson sample of about ``want`` records: half of the chances go by bytes, half by rows, so
    that neither long records nor many tiny ones overfill a range. ``w``: inverse-chance weight."""
    share = F.col("size") / F.lit(2.0 * total_bytes) + F.lit(0.5 / total_rows)
    chance = F.least(F.lit(1.0), share * F.lit(float(want)))
    draw = F.pmod(F.xxhash64(F.lit(seed), "tie", "key"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return rows.where(draw < chance).select("key", "tie", (share / chance).alias("w"))


def _quantiles(sample: DataFrame, pieces: Column, by: list[str], cols: list[str]) -> list[tuple]:
    """Keys at the equal-weight cut points of each group's sample."""
    cum = Window.partitionBy(*by).orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    cut = F.least(F.floor(F.sum("w").over(cum) / F.sum("w").over(whole) * pieces), pieces - 1)
    marked = sample.withColumn("cut", cut)
    last = F.lag("cut", 1, 0).over(Window.partitionBy(*by).orderBy("key", "tie"))
    return [tuple(r) for r in marked.withColumn("last", last).where("cut > last").select(*cols).distinct().collect()]


def shard_by_size(docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text",
                  ranges_per_shard: int = 16, rows_per_range: int = 1_000_000, oversample: int = 32,
                  whole_share: float = 0.05, seed: int = 17) -> DataFrame:
    """Put every record in one of ``shards`` shards of near-equal bytes.

    Returns one row per record: ``id, size long`` (UTF-8 bytes + 1), ``crc long`` (null for a null
    text), ``key, tie, range_no, shard int, slot long`` (gapless from 0 in key order). Equal texts
    are neighbours in key order; a group of copies of at most ``whole_share`` of a shard's bytes goes
    to one shard as a whole (unless its range had to be subdivided), a larger one is cut where the
    shards end, record by record. A shard is off the mean by one record or ``whole_share`` at most on
    either side. Null and empty texts have size 1, null ids sort as their hash, a repeated row is a
    record of its own, no records give no rows.

    Bounds: the sample holds about ``oversample * ranges`` keys and the driver one splitter and one
    load per range; ``ranges`` is ``ranges_per_shard * shards`` and grows so that a range holds about
    ``rows_per_range`` records.
    """
    rows = materialise(docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col(text_col)).alias("crc"), F.xxhash64(text_col).alias("key"),
        F.xxhash64(F.col(id_col), F.lit(seed)).alias("tie")), "records")
    total_rows, total_bytes = rows.agg(F.count("*"), F.sum("size")).first()
    if not total_rows:
        return rows.select("*", F.lit(0).alias("range_no"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    n = max(ranges_per_shard * shards, math.ceil(total_rows / rows_per_range))

    sample = _sampled(rows, oversample * n, total_bytes, total_rows, seed)
    splitters = sorted({(k, LOWEST) for (k,) in _quantiles(sample, F.lit(n), [], ["key"])})
    for level in range(1, 4):
        ranged = rows.withColumn("range_no", _range_of(splitters))
        loads = {r.range_no: r for r in ranged.groupBy("range_no").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.max("size").alias("longest")).collect()}
        over = {k: math.ceil(n * (r["bytes"] / total_bytes + r["rows"] / total_rows) / 2) for k, r in loads.items()
                if r["rows"] > 1 and (r["rows"] > 2 * max(1, total_rows / n)
                                      or r["bytes"] - r["longest"] > 2 * total_bytes / n)}
        if not over:
            break
        pieces = F.create_map(*[F.lit(x) for k, v in over.items() for x in (k, 2 * v)])[F.col("range_no")]
        inside = ranged.where(F.col("range_no").isin(list(over)))
        denser = _sampled(inside, 4 ** level * oversample * n, total_bytes, total_rows, seed + level)
        denser = denser.withColumn("range_no", _range_of(splitters)).withColumn("pieces", pieces)
        splitters = sorted({*splitters, *_quantiles(denser, F.col("pieces"), ["range_no"], ["key", "tie"])})
    else:
        ranged = rows.withColumn("range_no", _range_of(splitters))
        loads = {r.range_no: r for r in ranged.groupBy("range_no").agg(F.sum("size").alias("bytes")).collect()}

    starts, at = [], 0
    for k in range(len(splitters) + 1):
        starts.append(at)
        at += loads[k]["bytes"] if k in loads else 0
    start = F.element_at(F.lit(starts), F.col("range_no") + 1)
    in_order = Window.partitionBy("range_no").orderBy("key", "tie", "size", "crc")
    to_group = F.sum("size").over(Window.partitionBy("range_no").orderBy("key"))
    group = F.sum("size").over(Window.partitionBy("range_no", "key"))
    to_row = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    small = F.col("group") <= F.lit(whole_share * total_bytes / shards)
    middle = F.when(small, F.col("to_group") - F.col("group") / 2).otherwise(F.col("to_row") - F.col("size") / 2)
    placed = (ranged.withColumn("to_row", to_row).withColumn("to_group", to_group).withColumn("group", group)
              .withColumn("shard", F.least(F.lit(shards - 1), F.floor((start + middle) * shards / F.lit(total_bytes))).cast("int"))
              .withColumn("nth", F.row_number().over(Window.partitionBy("range_no", "shard").orderBy("key", "tie", "size", "crc"))))
    placed = materialise(placed.drop("to_row", "to_group", "group"), "placed")
    counts = placed.groupBy("shard", "range_no").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("range_no")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = materialise(counts.select("shard", "range_no", before.alias("before")), "offsets")
    return (placed.join(offsets, ["shard", "range_no"])
            .withColumn("slot", (F.col("before") + F.col("nth") - 1).cast("long"))
            .select("id", "size", "crc", "key", "tie", "range_no", "shard", "slot"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, *, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write the records as one folder per shard. Tasks are dealt by (shard, range), so a shard is
    written by many tasks; the file names follow the shard's ranges and rows keep their slot."""
    placed = assigned.select(F.col("id").alias("__id"), F.col("key").alias("__key"), "shard", "slot", "range_no").distinct()
    keyed = docs.drop("shard", "slot", "range_no").withColumn("__key", F.xxhash64(text_col))
    joined = keyed.join(placed.dropDuplicates(["__id", "__key"]),
                        F.col(id_col).eqNullSafe(F.col("__id")) & (keyed["__key"] == placed["__key"]))
    out = joined.drop("__id").drop(keyed["__key"]).drop(placed["__key"])
    (out.repartition("shard", "range_no").sortWithinPartitions("shard", "slot").drop("range_no")
     .write.partitionBy("shard").parquet(path))
