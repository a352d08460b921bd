"""One totals row per reporting date, at fixed positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesada.functions.text import nvl

# Counts multiply amounts; decimal(18,0) keeps the product inside 38 digits.
WEIGHT = "decimal(18,0)"


def weighted_sum(value: Column, weight: Column | None = None, guard: bool = True) -> Column:
    """A3, A4, A5: sum over rows that stand for `weight` equal rows each.

    `guard` makes NULL values zero (A3, A5); without it an all-NULL or empty sum stays
    NULL (A4). The default for empty input is applied in `totals_per_date`.
    """
    value = nvl(value, 0) if guard else value
    return F.sum(value if weight is None else value * weight.cast(WEIGHT))


def totals_per_date(
    facts: DataFrame, dates: DataFrame, guarded: dict[str, Column], unguarded: dict[str, Column]
) -> DataFrame:
    """A3, A4: totals by `as_of`, one row for every date, also for dates without facts.

    `facts` may be partial sums already; the aggregate combines map-side, so a date that
    owns most rows costs one partial row per task.
    """
    sums = facts.groupBy("as_of").agg(
        *[c.alias(n) for n, c in {**guarded, **unguarded}.items()]
    )
    out = dates.select("as_of").join(sums, "as_of", "left")
    return out.select(
        "as_of",
        *[nvl(F.col(n), 0).alias(n) for n in guarded],
        *[F.col(n) for n in unguarded],
    )


def positional(
    df: DataFrame, layout: Sequence[str | None], label: str, empty: str | None = None
) -> DataFrame:
    """Columns at fixed positions. None is a placeholder, the first is the row label.

    Placeholders get the names c02, c03, ...; the order is the contract.
    """


    def constant(value: str | None, i: int) -> str:
        text = "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"CAST({text} AS STRING) AS c{i:02d}"

    cols = [constant(label, 1)]
    for i, name in enumerate(layout[1:], start=2):
        cols.append(constant(empty, i) if name is None else f"`{name}`")
    keep = ["as_of"] if "as_of" in df.columns else []
    return df.selectExpr(*keep, *cols)
