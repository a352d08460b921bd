"""B1: label of the intraday batch a timestamp belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from mesada.functions.dates import yymmdd

# First hour, last hour, batch. Hours 10 and 16-06 belong to no batch.
BATCHES = ((7, 9, "0900"), (11, 13, "1300"), (14, 15, "1500"))
FIRST_BATCH = "0900"


def cutoff_label(ts: Column, windows: Sequence[tuple[int, int, str]] = BATCHES) -> Column:
    """`yyMMdd.HHmm` of the batch, NULL outside every window."""
    suffix = None
    for first, last, batch in windows:
        hit = F.hour(ts).between(first, last)
        suffix = (F if suffix is None else suffix).when(hit, F.lit("." + batch))
    # The date is formatted only for the hours of a batch.
    return F.when(suffix.isNotNull(), F.concat(yymmdd(F.to_date(ts)), suffix))


def cutoff_base(d: Column) -> Column:
    """Label of the first batch of a day."""
    return F.concat(yymmdd(d), F.lit("." + FIRST_BATCH))


def cutoff_matches(label: Column, base: Column, op: str) -> Column:
    """L6 (`=`) and L7 (`>`, as text). A NULL label never matches."""
    if op == "=":
        return label == base
    if op == ">":
        return label > base
    raise ValueError(f"cutoff operator {op!r}: expected '=' or '>'")
