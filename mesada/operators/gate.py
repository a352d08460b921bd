"""The month gate, type and batch filters on fact rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesada.functions.cutoff import cutoff_base, cutoff_label, cutoff_matches
from mesada.functions.dates import SATURDAY, SUNDAY, month_start
from mesada.operators.calendar import ReportCalendar

# A first business day is at most three days after the first of the month.
FIRST_BUSINESS_DAY_SPAN = dt.timedelta(days=4)


def weekday_guard(cal: DataFrame) -> DataFrame:
    """L3: calendar rows whose run date is not a Saturday or Sunday."""
    return cal.filter(~F.col("dow_hoy").isin(SUNDAY, SATURDAY))


def open_months(cal: DataFrame, lag_days: int = 0) -> DataFrame:
    """L1, L2: (as_of, mes, corte_base) for the dates on which the gate is open.

    The gate is open when `as_of` minus the lag is the first business day of its month;
    a closed gate lets no row pass, so its date is simply absent here.
    """
    return cal.filter(F.date_sub("as_of", lag_days) == F.col("primer_dia_mes")).select(
        "as_of",
        month_start(F.col("primer_dia_mes"), -1).alias("mes"),
        cutoff_base(F.col("primer_dia_habil_mes")).alias("corte_base"),
    )


def gate_span(cal: ReportCalendar, op: str | None = None) -> tuple[dt.date, dt.date]:
    """First day and end of what the gate can let through; the months must be known."""
    first, last = cal.first_month, cal.last_month
    # The first batch of the first business day lies in the first days of the month.
    end = (
        last + FIRST_BUSINESS_DAY_SPAN
        if op == "="
        else (last + dt.timedelta(days=31)).replace(day=1)
    )
    return first, end


def month_gate(
    df: DataFrame,
    cal: ReportCalendar,
    ts_col: str,
    lag_days: int = 0,
    guard: bool = False,
    cutoff_op: str | None = None,
    month_col: str | None = None,
) -> DataFrame:
    """L1-L3 and, with `cutoff_op`, L6/L7: fact rows of the reported months, with `as_of`.

    Adds `as_of`, and `corte` with `cutoff_op`. The open calendar rows are not hinted: Spark
    measures them, and broadcasts them as long as they are small. Facts stored by month (`month_col`, a date) are pruned to the partitions asked for.
    """
    frame = weekday_guard(cal.frame) if guard else cal.frame
    gate = open_months(frame, lag_days)
    if cal.first_month is not None:
        lo, hi = gate_span(cal, cutoff_op)
        ts_type = df.schema[ts_col].dataType
        df = df.filter(
            (F.col(ts_col) >= F.lit(lo).cast(ts_type)) & (F.col(ts_col) < F.lit(hi).cast(ts_type))
        )
        if month_col:
            df = df.filter(F.col(month_col).between(F.lit(cal.first_month), F.lit(cal.last_month)))
    month = F.col(month_col) if month_col else F.trunc(ts_col, "MM")
    on = month == F.col("mes")
    if cutoff_op:
        df = df.withColumn("corte", cutoff_label(F.col(ts_col)))
        on = on & cutoff_matches(F.col("corte"), F.col("corte_base"), cutoff_op)
    return df.join(gate, on).drop("mes", "corte_base")


def gate_parts(
    parts: DataFrame, cal: ReportCalendar, lag_days: int = 0, cutoff_op: str = "="
) -> DataFrame:
    """L1-L3, L6, L7 on rows that stand for all facts of a month (`mes`) and batch (`corte`)."""
    if cal.first_month is not None:
        parts = parts.where(F.col("mes").between(F.lit(cal.first_month), F.lit(cal.last_month)))
    gate = open_months(cal.frame, lag_days).withColumnRenamed("mes", "gate_mes")
    on = (F.col("mes") == F.col("gate_mes")) & cutoff_matches(
        F.col("corte"), F.col("corte_base"), cutoff_op
    )
    return parts.join(gate, on).drop("gate_mes", "corte_base")


def type_filter(col: Column, types: Sequence[int]) -> Column:
    """Detail type is one of `types`."""
    return col == types[0] if len(types) == 1 else col.isin(*types)


def cutoff_filter(df: DataFrame, label: str, base: str, op: str) -> DataFrame:
    """Keep rows whose batch label compares with the base label."""
    return df.filter(cutoff_matches(F.col(label), F.col(base), op))
