"""Relational curation of one landed table: type -> validate -> dedupe -> (curated, rejected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.dedupe import dedupe
from daybook.operators.typing import cast_by_rules
from daybook.operators.validate import invalid_mask, split
from daybook.spec import DUPLICATE_KEY_REASON, TableSpec


class CuratedBatch:
    """Outputs of curating one landed table; each frame is built on first use (building a frame
    runs analysis on the driver, and summaries only need the typed rows)."""

    def __init__(self, spec: TableSpec, typed: DataFrame, keys: tuple[str, ...], mode: str = "all"):
        self.spec, self.typed, self.keys, self.mode = spec, typed, keys, mode
        self._split = None
        self._dedupe = None

    def _splits(self):
        if self._split is None:
            self._split = split(self.typed, self.spec.all_rules(), self.mode)
        return self._split

    def _dedupes(self):
        if self._dedupe is None:
            self._dedupe = dedupe(self._splits()[0], list(self.keys), ["ingest_ts"], DUPLICATE_KEY_REASON)
        return self._dedupe

    @property
    def business_rejected(self) -> DataFrame:
        return self._splits()[1]

    @property
    def valid(self) -> DataFrame:
        """Kept rows: rule-valid and newest per key."""
        return self._dedupes()[0]

    @property
    def duplicate_rejected(self) -> DataFrame:
        return self._dedupes()[1]

    def rejected(self) -> DataFrame:
        """Business and duplicate rejects; missing columns are NULL (``rejected_at`` is added by the sink)."""
        return self.business_rejected.unionByName(self.duplicate_rejected, allowMissingColumns=True)

    def counts(self) -> DataFrame:
        """(table_name, source_rows, valid_rows, rejected_rows) without running the dedupe.

        The kept rows are exactly one per distinct key among rule-valid rows, so one two-level
        aggregate answers it: group by (invalid, key) -- all invalid rows fall into one group --
        then sum the group sizes and count the valid groups. Both levels combine map-side, so a
        hot key never travels as raw rows. Duplicates = valid - kept.
        """
        bad = invalid_mask(self.spec.all_rules())
        groups = self.typed.groupBy(bad.alias("_bad"), *[F.when(~bad, F.col(k)).alias(k) for k in self.keys]) \
            .agg(F.count(F.lit(1)).alias("_n"))
        return groups.agg(
            F.sum("_n").cast("bigint").alias("source_rows"),
            F.count_if(~F.col("_bad")).cast("bigint").alias("valid_rows"),
        ).select(F.lit(self.spec.name).alias("table_name"), "source_rows", "valid_rows",
                 (F.col("source_rows") - F.col("valid_rows")).alias("rejected_rows"))


def curate(landed: DataFrame, spec: TableSpec, mode: str = "all", per_batch: bool = True) -> CuratedBatch:
    """Curate landed rows of one or many daily batches (dedupe stays inside a batch)."""
    typed = cast_by_rules(landed, spec.casts)
    keys = list(spec.primary_key) + (["processing_date"] if per_batch and "processing_date" in landed.columns else [])
    return CuratedBatch(spec, typed, tuple(keys), mode)
