"""MERGE semantics as DataFrame operators (no table format needed).

``upsert`` returns the new state of the target; the sinks decide how much of it is rewritten
(only the touched partitions, see ``sinks.tables.PartitionedTable``). Precondition: one writer per
table at a time, as the reference's single active run guarantees.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateSourceKeyError(ValueError):
    """Two source rows match the same target key: MERGE refuses this, so do we."""


def _ambiguous(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that two source rows share and a target row has, with their target rows (``_hits``)."""
    twice = source.filter(_no_null(keys)).groupBy(*keys).count().filter(F.col("count") > 1).select(*keys)
    return twice.join(target.select(*keys), list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_hits"))


def assert_unique(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise now if two source rows match one target row; one such key reaches the driver."""
    dup = _ambiguous(target, source, keys).limit(1).collect()
    if dup:
        raise DuplicateSourceKeyError(f"duplicate source key {dup[0].asDict()}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_when: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
           check_unique: bool = True) -> DataFrame:
    """New target state after ``MERGE ... WHEN MATCHED [AND cond] UPDATE SET * WHEN NOT MATCHED INSERT *``.

    Key equality is SQL equality: a NULL key never matches, so such source rows are inserted and
    such target rows are kept. ``update_when(s, t)`` receives column accessors of both sides;
    without it a match always takes the source row. Columns are aligned by name to the target.
    Two source rows that match one target row fail the query when it runs (building the frame runs
    nothing); source rows that share a key which no target row has are all inserted, as in MERGE.
    """
    cols = target.columns
    source = source.select(*cols)
    # rows with a NULL key match nothing: they stay out of the joins, where they would all meet in one task
    keyed, unkeyed = source.filter(_no_null(keys)), source.filter(~_no_null(keys))
    source_keys = keyed.select(*keys).distinct()
    untouched = target.join(source_keys, list(keys), "left_anti")
    if update_when is None:
        out = untouched.unionByName(source)
    else:
        # Only target rows whose key occurs in the source can change: split the target by the
        # source's key set (broadcast by AQE when that set is small, so the large target is not
        # shuffled) and run the comparing full outer join on the touched rows only.
        t = target.join(source_keys, list(keys), "left_semi").withColumn("_t", F.lit(True)).alias("t")
        s = keyed.withColumn("_s", F.lit(True)).alias("s")
        joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full")

        def sc(c: str) -> Column:
            return F.col(f"s.{c}")

        def tc(c: str) -> Column:
            return F.col(f"t.{c}")

        take_source = F.col("s._s").isNotNull() & (F.col("t._t").isNull() | F.coalesce(update_when(sc, tc), F.lit(False)))
        merged = joined.select(*[F.when(take_source, sc(c)).otherwise(tc(c)).alias(c) for c in cols])
        out = untouched.unionByName(merged).unionByName(unkeyed)
    if check_unique:
        # the message names the aggregate's count, so that the filter stays above it
        message = F.concat(F.lit("duplicate source key "), F.to_json(F.struct(*keys)), F.lit(" for target rows: "), F.col("_hits").cast("string"))
        fails = _ambiguous(target, source, keys).filter(F.raise_error(message).cast("string").isNotNull())
        out = out.unionByName(fails.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields]))
    return out


def latest_wins(ts: str) -> Callable:
    """Update only when the incoming event is not older than the stored one (``s.ts >= t.ts``)."""
    return lambda s, t: s(ts) >= t(ts)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``INSERT IGNORE``: rows whose key exists are dropped, the first writer's row is kept.

    Within the batch itself the first row per key wins; Spark rows have no statement order, so
    "first" is the smallest full row, which is deterministic.
    """
    from daybook.operators.dedupe import latest_by

    cols = target.columns
    batch = batch.select(*cols)
    first = latest_by(batch, keys, [F.col(c).asc_nulls_last() for c in sorted(cols) if c not in keys],
                      tiebreak=False)
    new = first.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new)


def _no_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond
