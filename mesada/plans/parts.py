"""R5-R8 from stored partial sums: totals of many months without reading their facts again.

Sums over pairings add up over months, batches and detail types. A table of them, partitioned
by month, holds what each month's facts come to; a month whose facts or lookups changed is
computed anew and replaces its own partition only. A report joins the few rows of its months
with its calendar, by the same month and batch rules as the facts, and adds them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mesada.functions.cutoff import cutoff_label
from mesada.operators.calendar import ReportCalendar
from mesada.operators.gate import gate_parts, type_filter
from mesada.operators.totals import totals_per_date, weighted_sum
from mesada.plans.reports import (
    Tables,
    _disbursement_amounts,
    _disbursement_row,
    _disbursement_sums,
    _transfer_amounts,
    _transfer_row,
    _transfer_sums,
)
from mesada.profiles import Profile, get_profile

KEYS = ["mes", "corte", "tipo"]
DISBURSEMENT, TRANSFER = "disbursement", "transfer"


def _of_months(df: DataFrame, months: list[dt.date] | None, month_col: str | None) -> DataFrame:
    """Sendings of the months, by a range that reaches the scan and by their partitions."""
    month = F.col(month_col) if month_col else F.trunc("fechaenvio", "MM")
    df = df.withColumn("mes", month)
    if months is None:
        return df
    kind = df.schema["fechaenvio"].dataType
    first, end = min(months), (max(months) + dt.timedelta(days=31)).replace(day=1)
    df = df.where(
        (F.col("fechaenvio") >= F.lit(first).cast(kind))
        & (F.col("fechaenvio") < F.lit(end).cast(kind))
    )
    return df.where(month.isin(*months))


def partial_totals(
    t: Tables, report: str, profile: Profile | str = "v1", months: list[dt.date] | None = None,
    month_col: str | None = None,
) -> DataFrame:
    """Sums by (mes, corte, tipo) of the sendings of some months, or of all.

    Sendings outside every batch are left out: no report counts them.
    """
    p = get_profile(profile)
    transfer = report == TRANSFER
    types = p.transfer_total_types if transfer else p.disbursement_types
    c = F.col
    rows = t["desembolsorelacion"].filter(type_filter(c("IdDesembolsoDetalle"), types))
    rows = _of_months(rows, months, month_col).select(
        "mes", cutoff_label(c("fechaenvio")).alias("corte"), c("IdDesembolsoDetalle").alias("tipo"),
        "solicitud", "montoDesembolsar",
    )
    rows = rows.where("mes IS NOT NULL AND corte IS NOT NULL").groupBy(*KEYS, "solicitud")
    if transfer:
        sent = rows.agg(weighted_sum(F.abs(c("montoDesembolsar"))).alias("sent"))
        facts, sums = _transfer_amounts(t, sent), _transfer_sums()
    else:
        sent = rows.agg(F.count("*").alias("dre_n"))
        facts, sums = _disbursement_amounts(t, sent, p), _disbursement_sums()
    both: dict[str, Column] = {**sums[0], **sums[1]}
    return facts.groupBy(*KEYS).agg(*[v.alias(n) for n, v in both.items()])


def write_partial_totals(
    t: Tables, path: str, report: str, profile: Profile | str = "v1",
    months: Iterable[dt.date] | None = None, month_col: str | None = None,
) -> None:
    """Compute the partial sums of some months and replace theirs in the table at ``path``.

    Months are given by their first day; without them the whole table is written. A month that
    has no sendings left gets a row without a batch, which no report counts, so what it had is
    replaced too. Months that are not named are neither read nor touched.
    """
    months = None if months is None else sorted({m.replace(day=1) for m in months})
    if months == []:
        return
    parts = partial_totals(t, report, profile, months, month_col)
    writer_mode = "static"
    if months is not None:
        days = ", ".join(f"(DATE '{m:%Y-%m-%d}')" for m in months)
        marks = parts.sparkSession.sql(f"SELECT mes FROM VALUES {days} AS dias(mes)")
        parts = parts.unionByName(marks, allowMissingColumns=True)
        writer_mode = "dynamic"
    (
        parts.repartition("mes")  # a month's sums are few rows: one file each
        .write.mode("overwrite")
        .option("partitionOverwriteMode", writer_mode)
        .partitionBy("mes")
        .parquet(path)
    )


def totals_from_parts(
    spark: SparkSession, path: str, cal: ReportCalendar, report: str,
    profile: Profile | str = "v1", with_as_of: bool = True,
) -> DataFrame:
    """The totals of a calendar's dates from the stored partial sums.

    Equal to `disbursement_totals` or `transfer_totals` on the facts that the sums were made
    from. Only the partitions of the calendar's months are read.
    """
    p = get_profile(profile)
    transfer = report == TRANSFER
    types = p.transfer_total_types if transfer else p.disbursement_types
    lag = 0 if transfer else p.totals_lag_days
    parts = spark.read.parquet(path).withColumn("mes", F.col("mes").cast("date"))
    parts = parts.where(F.col("corte").isNotNull() & type_filter(F.col("tipo"), types))
    met = gate_parts(parts, cal, lag, p.cutoff_op)
    guarded, plain = _transfer_sums() if transfer else _disbursement_sums()
    sums = totals_per_date(
        met,
        cal.frame,
        {n: weighted_sum(F.col(n)) for n in guarded},
        {n: weighted_sum(F.col(n), guard=False) for n in plain},
    )
    return (_transfer_row if transfer else _disbursement_row)(sums, p, with_as_of)
