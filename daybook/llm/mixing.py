"""Mixing sources to target weights by capped water-filling and seeded repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.shared import WORD_PATTERN, materialise


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, cap: float) -> DataFrame:
    """``sources(source, source_size, weight)`` plus ``target``: the total of all sizes is shared by
    weight; a source stops at ``cap`` times its size and what it leaves goes to the others by weight,
    until none is above. Per round the driver holds three sums; the level only rises, so the
    clamped set only grows and the rounds end."""
    limit = F.col("source_size") * F.lit(cap)
    rest, free = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total = rest
    while total:
        at_limit = F.col("weight") * F.lit(float(rest)) / F.lit(float(free)) > limit
        clamped, left = sources.agg(F.sum(F.when(at_limit, limit)), F.sum(F.when(~at_limit, F.col("weight")))).first()
        now = total - (clamped or 0)
        if left is None or (now, left) == (rest, free):
            break
        rest, free = now, left
    if not total:
        return sources.withColumn("target", F.lit(0.0))
    share = F.col("weight") * F.lit(float(rest)) / F.lit(float(free))
    return sources.withColumn("target", F.least(share, limit.cast("double")))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), *, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", cap: int = 3, seed: int = 29) -> DataFrame:
    """How often each record enters the mix.

    Size is the number of words. Sources take ``weights`` in turn, by code point, null last, and
    share the total of all sizes by capped water-filling. A source whose target is r times its size takes
    every record floor(r) times, and once more the records at the head of a seeded permutation (order
    of ``md5(seed:id:md5(text))``) as far as their middle lies within the words still missing. The source is
    then off its target by half of one record at most, and a rerun takes the same records.

    Returns one row per record: ``id, th, source, size long, source_size long, target double, reps int,
    taken long`` (th: md5 of the text, null: of none). Null texts have size 0; records of size 0 take nothing and are
    never repeated; repeated rows are records of their own that sit next to each other in the permutation; no records
    give no rows.

    A hot source is no hot task, nor is an id that many texts share: the permutation is cut into 4,096 buckets, whole
    buckets are decided by their sums, and only the one bucket in which a source's head ends is ordered row by row.
    """
    th = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), th))
    rows = materialise(
        docs.select(F.col(id_col).alias("id"), th.alias("th"), F.col(source_col).alias("source"),
                    word_count(F.col(text_col)).alias("size"), order.alias("ord"))
        .withColumn("bucket", F.conv(F.substring("ord", 1, 3), 16, 10).cast("int")), "sized")
    sums = materialise(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "bucket_sums")
    per_source = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.lit([int(w) for w in weights]), (F.pmod(nth, F.lit(len(weights))) + 1).cast("int"))
    sources = water_fill(materialise(per_source.withColumn("weight", weight), "sources"), cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    sources = sources.withColumn("whole", whole.cast("int")) \
        .withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    sources = materialise(sources.withColumnRenamed("source", "src"), "targets")

    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    ends = (sums.withColumn("upto", upto).join(sources, F.col("source").eqNullSafe(F.col("src")))
            .where("upto > missing").groupBy("src").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("e")))
    cuts = materialise(
        sources.alias("s").join(ends.select(F.col("src").alias("esrc"), "e.bucket", "e.before"), F.col("src").eqNullSafe(F.col("esrc")), "left")
        .select("src", "source_size", "target", "whole", "missing", F.coalesce("bucket", F.lit(1 << 20)).alias("cut"),
                F.coalesce("before", F.lit(0)).alias("before")), "cuts")
    joined = rows.join(cuts, F.col("source").eqNullSafe(F.col("src")))
    kept = ["id", "th", "source", "size", "source_size", "target", "whole"]
    decided = joined.where("bucket <> cut").select(*kept, (F.col("bucket") < F.col("cut")).cast("int").alias("extra"))
    run = Window.partitionBy("source").orderBy("ord", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto_row = F.col("before") + F.sum("size").over(run)
    edge = joined.where("bucket = cut").select(*kept, ((upto_row - F.col("size") / 2) <= F.col("missing")).cast("int").alias("extra"))
    reps = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0).cast("int")
    return decided.union(edge).select("id", "th", "source", "size", "source_size", "target", reps.alias("reps"),
                                      (reps * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, mixture: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The records of the mix with all their columns, each as often as it was taken (its repetitions
    are equal rows). Records are told apart by id, text and source; of those that share all three as many are taken
    once more as the mix takes (at most one such group of a source has records that differ in that)."""
    key = ["__id", "__th", "__src"]
    reps = mixture.groupBy(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("source").alias("__src")).agg(
        F.min("reps").alias("__reps"), F.sum("reps").alias("__sum"), F.count("*").alias("__rows"))
    reps = reps.withColumn("__more", F.col("__sum") - F.col("__reps") * F.col("__rows")).where("__sum > 0")
    reps = reps.drop("__sum", "__rows").hint("merge")  # it grows with the documents: the same plan at every size
    named = docs.withColumn("__h", F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    found = named.join(reps, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th"))
                       & F.col(source_col).eqNullSafe(F.col("__src")))
    equal = found.where("__more = 0").withColumn("__n", F.col("__reps"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0)))
    mixed = found.where("__more > 0").withColumn("__n", F.col("__reps") + (nth <= F.col("__more")).cast("int"))
    out = equal.unionByName(mixed).where("__n > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
    return out.select(*docs.columns)
