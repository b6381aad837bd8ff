"""Reference routing: split rows into known / unknown against master key sets in one plan."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.spec import UNKNOWN_REFERENCE_REASON


def flag_references(df: DataFrame, refs: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Left-join each reference (frame, key, carried columns) and add ``_has_<key>``.

    The reference side is one row per key (a master after ``latest_master``), so the join never
    multiplies rows. AQE picks broadcast when the runtime size of that side is under the
    broadcast threshold (a checked bound) and a skew-split sort-merge join otherwise.
    """
    out = df
    for ref, key, carry in refs:
        side = ref.select(key, *carry).withColumn(f"_has_{key}", F.lit(True))
        out = out.join(side, key, "left").withColumn(f"_has_{key}", F.coalesce(F.col(f"_has_{key}"), F.lit(False)))
    return out


def route(df: DataFrame, refs: Sequence[tuple[DataFrame, str, Sequence[str]]],
          reason: str = UNKNOWN_REFERENCE_REASON) -> tuple[DataFrame, DataFrame]:
    """(known, unknown). A row unknown on both sides appears once among the unknown rows.

    Known rows carry the referenced columns; unknown rows keep only the input columns plus
    ``reject_reason``.
    """
    flagged = flag_references(df, refs)
    flags = [F.col(f"_has_{key}") for _, key, _ in refs]
    all_known = flags[0]
    for f in flags[1:]:
        all_known = all_known & f
    flag_cols = [f"_has_{key}" for _, key, _ in refs]
    known = flagged.filter(all_known).drop(*flag_cols)
    unknown = (flagged.filter(~all_known).select(*df.columns)
               .withColumn("reject_reason", F.lit(reason)))
    return known, unknown


def known_keys(master: DataFrame, key: str, as_of: str | None = None) -> DataFrame:
    """Distinct non-null keys of a master, optionally only partitions up to ``as_of``."""
    m = master if as_of is None else master.filter(F.col("processing_date") <= F.lit(as_of))
    return m.select(key).filter(F.col(key).isNotNull()).distinct()
