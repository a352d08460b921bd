"""O1: report order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_by_ordinal(df: DataFrame, n: int, skip: int = 0) -> DataFrame:
    """O1: sort by the n-th column ascending, NULLs last.

    The other columns break ties, which the reports leave open. That also gives the range
    exchange distinct keys: a constant sort column (one batch label for a whole report)
    would otherwise send every row to one task. `skip` leading columns (as_of) sort first.
    """
    lead, rest = df.columns[:skip], df.columns[skip:]
    keys = [*lead, rest[n - 1], *[c for i, c in enumerate(rest) if i != n - 1]]
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in keys])
