"""Validation: rules -> reject reason per row, and an exact valid / rejected split."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.fixed_values import REASON_SEPARATOR
from daybook.spec import DEFAULT_REASON, Rule

MODES = ("all", "first", "last")


def invalid_mask(rules: Sequence[Rule], masks: Sequence[Column] | None = None) -> Column:
    """True for a bad row; never NULL (a NULL outcome is decided per rule)."""
    if not rules:
        return F.lit(False)
    return reduce(lambda a, b: a | b, list(masks) if masks is not None else [r.mask() for r in rules])


def reason_column(rules: Sequence[Rule], mode: str = "all") -> Column:
    """Reject reason; NULL for a valid row.

    * ``all``   every failing message, in rule order, joined by ``"; "``
    * ``first`` the first failing rule wins
    * ``last``  the last failing rule wins
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if not rules:
        return F.lit(None).cast("string")
    masks = [r.mask() for r in rules]
    messages = [F.when(m, F.lit(r.message)) for r, m in zip(rules, masks)]
    if mode == "all":
        joined = F.concat_ws(REASON_SEPARATOR, *messages)
        return F.when(invalid_mask(rules, masks), F.coalesce(F.nullif(joined, F.lit("")), F.lit(DEFAULT_REASON)))
    return F.coalesce(*(messages if mode == "first" else messages[::-1]))


def validate(df: DataFrame, rules: Sequence[Rule], mode: str = "all") -> DataFrame:
    """Tag every row with ``reject_reason`` (NULL = valid). A table without rules never rejects."""
    return df.withColumn("reject_reason", reason_column(rules, mode))


def split(df: DataFrame, rules: Sequence[Rule], mode: str = "all") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): every input row lands in exactly one side.

    Both sides come from the same tagged plan; a caller that materialises both should persist or
    write the tagged frame once (see ``plans.stages``).
    """
    tagged = validate(df, rules, mode)
    valid = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = tagged.filter(F.col("reject_reason").isNotNull())
    return valid, rejected
