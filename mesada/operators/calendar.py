"""Business calendar for any number of reporting dates in one job.

Every rule has the same shape. A month anchor is moved to the nearest weekday (the
landing day); when the probed day is a holiday and matches the landing day, the result
moves on once more, over the weekend if needed, and is not tested again (Q4). So one
holiday lookup per anchor is enough, and it is an equi-join on a small table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mesada.functions.dates import (
    FRIDAY,
    MONDAY,
    SATURDAY,
    SUNDAY,
    dow,
    month_end,
    month_name,
    month_start,
    yymmdd,
)
from mesada.functions.text import nvl

# Fixed value: stands for "not a holiday".
NO_HOLIDAY = dt.date(1900, 1, 1)


def as_of_frame(spark: SparkSession, dates: Iterable[dt.date]) -> DataFrame:
    """The reporting dates, one row each. Stands for a one-row constant relation."""
    rows = ", ".join(f"(DATE '{d:%Y-%m-%d}')" for d in sorted(set(dates)))
    if not rows:
        return spark.createDataFrame([], "as_of date")
    return spark.sql(f"SELECT * FROM VALUES {rows} AS dates(as_of)")


def holiday_or_epoch(
    df: DataFrame, probe: Column, holidays: DataFrame, out: str, strict: bool = True
) -> DataFrame:
    """Add `out` = the probed date if it is a holiday, else 1900-01-01.

    A date listed twice makes a single-row lookup fail; `strict` keeps that for the dates
    probed, otherwise repeated dates count once. One row per date bounds the holiday side, so it is small
    enough for Spark to broadcast; nothing is hinted.
    """
    hol = holidays.groupBy(F.col("fecha").alias(f"{out}__d")).agg(F.count("*").alias(f"{out}__n"))
    found = F.col(f"{out}__d")
    if strict:
        found = F.when(
            F.col(f"{out}__n") > 1, F.raise_error(F.lit("holiday listed more than once"))
        ).otherwise(found)
    return (
        df.join(hol, probe == F.col(f"{out}__d"), "left")
        .withColumn(out, nvl(found, F.lit(NO_HOLIDAY)))
        .drop(f"{out}__d", f"{out}__n")
    )


def _at_or_after(d: Column) -> Column:
    """First weekday at or after a day."""
    shift = F.when(dow(d) == SATURDAY, 2).when(dow(d) == SUNDAY, 1).otherwise(0)
    return F.date_add(d, shift)


def _at_or_before(d: Column) -> Column:
    """Last weekday at or before a day."""
    shift = F.when(dow(d) == SATURDAY, 1).when(dow(d) == SUNDAY, 2).otherwise(0)
    return F.date_sub(d, shift)


def _next_weekday(d: Column) -> Column:
    return F.date_add(d, F.when(dow(d) == FRIDAY, 3).otherwise(1))


def _previous_weekday(d: Column) -> Column:
    return F.date_sub(d, F.when(dow(d) == MONDAY, 3).otherwise(1))


def _probe(anchor: Column, landing: Column, as_of: Column, rule: str) -> Column:
    """Day looked up in the holiday table.

    Rule "anchor" looks at the landing day. Rule "today" (Q2) applies the weekend shift
    to the run date instead of the anchor, so a weekend anchor is tested on another day.
    """
    if rule == "anchor":
        return landing
    if rule == "today":
        return F.when(landing == anchor, anchor).otherwise(
            F.date_add(as_of, F.datediff(landing, anchor))
        )
    raise ValueError(f"holiday rule {rule!r}: expected 'today' or 'anchor'")


def first_business_day(
    df: DataFrame, anchor: str, holidays: DataFrame, out: str, rule: str = "today",
    strict: bool = True,
) -> DataFrame:
    """C5 (rule "today") and C6 (rule "anchor"): first business day at or after `anchor`."""
    a, landing = F.col(anchor), _at_or_after(F.col(anchor))
    probed = holiday_or_epoch(
        df, _probe(a, landing, F.col("as_of"), rule), holidays, "__hol", strict
    )
    hit = F.col("__hol") == landing
    return probed.withColumn(out, F.when(hit, _next_weekday(landing)).otherwise(landing)).drop(
        "__hol"
    )


def last_business_day(
    df: DataFrame, anchor: str, holidays: DataFrame, out: str, rule: str = "today",
    strict: bool = True,
) -> DataFrame:
    """Last business day at or before `anchor`; rule "anchor" is the corrected option."""
    a, landing = F.col(anchor), _at_or_before(F.col(anchor))
    probed = holiday_or_epoch(
        df, _probe(a, landing, F.col("as_of"), rule), holidays, "__hol", strict
    )
    hit = F.col("__hol") == landing
    return probed.withColumn(
        out, F.when(hit, _previous_weekday(landing)).otherwise(landing)
    ).drop("__hol")


def first_business_day_two_step(df: DataFrame, holidays: DataFrame, out: str) -> DataFrame:
    """Next weekday after the end of the month before last, one day later on a holiday."""
    end = month_end(F.col("as_of"), -2)
    step = _at_or_after(F.date_add(end, 1))
    probed = holiday_or_epoch(df, step, holidays, "__hol")
    return probed.withColumn(
        out, F.date_add(step, F.when(F.col("__hol") == step, 1).otherwise(0))
    ).drop("__hol")


def last_business_day_two_step(df: DataFrame, holidays: DataFrame, out: str) -> DataFrame:
    """Weekday before the end of last month, one day earlier on a holiday.

    It always moves back, so a month that ends on a working day gives the day before.
    """
    end = month_end(F.col("as_of"), -1)
    step = _at_or_before(F.date_sub(end, 1))
    probed = holiday_or_epoch(df, step, holidays, "__hol")
    return probed.withColumn(
        out, F.date_sub(step, F.when(F.col("__hol") == step, 1).otherwise(0))
    ).drop("__hol")


def business_calendar(
    dates: DataFrame, holidays: DataFrame, rule: str = "today", strict: bool = True
) -> DataFrame:
    """C11: one row per `as_of` with the anchors and business days the reports need."""
    as_of = F.col("as_of")
    cal = dates.select("as_of").distinct().select(
        "as_of",
        dow(as_of).alias("dow_hoy"),
        month_start(as_of, -1).alias("dia_ini_mes"),
        month_start(as_of).alias("dia_fin_mes"),
    )
    cal = first_business_day(cal, "dia_ini_mes", holidays, "primer_dia_habil_mes", rule, strict)
    return first_business_day(cal, "dia_fin_mes", holidays, "primer_dia_mes", rule, strict)


@dataclass(frozen=True)
class ReportCalendar:
    """Calendar rows plus, when the dates are known up front, the span of fact months.

    An open gate asks for the month before its business day, and that day lies in the month
    of `as_of`, with a lag or without. So the span follows from the dates alone, and the
    scan gets a literal range (Z2).
    """

    frame: DataFrame
    first_month: dt.date | None = None
    last_month: dt.date | None = None


def _previous_month(d: dt.date) -> dt.date:
    return (d.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def report_calendar(
    spark: SparkSession, dates: Iterable[dt.date] | DataFrame, holidays: DataFrame,
    rule: str = "today", strict: bool = True, measure_span: bool = False,
) -> ReportCalendar:
    """Calendar for literal dates, or for a DataFrame of `as_of`.

    Literal dates give the fact scan a range at once. For a DataFrame, `measure_span` runs
    one small job for its first and last date; without it no range is pushed.
    """
    if isinstance(dates, DataFrame):
        frame = business_calendar(dates, holidays, rule, strict)
        if not measure_span:
            return ReportCalendar(frame)
        first, last = dates.agg(F.min("as_of"), F.max("as_of")).first()
        if first is None:
            return ReportCalendar(frame)
    else:
        dates = set(dates)
        frame = business_calendar(as_of_frame(spark, dates), holidays, rule, strict)
        if not dates:
            return ReportCalendar(frame)
        first, last = min(dates), max(dates)
    return ReportCalendar(frame, _previous_month(first), _previous_month(last))


def start_dates(dates: DataFrame, holidays: DataFrame, rule: str = "today") -> DataFrame:
    """C12 (rules "today", "anchor") and C14 ("two_step"): start date text per `as_of`."""
    if rule == "two_step":
        df = first_business_day_two_step(dates.select("as_of").distinct(), holidays, "d")
        return df.select("as_of", yymmdd(F.col("d")).alias("FECHA_INICIO"))
    df = dates.select("as_of").distinct().withColumn("a", month_start(F.col("as_of"), -1))
    df = first_business_day(df, "a", holidays, "d", rule)
    return df.select("as_of", yymmdd(F.col("d")).alias("primer_dia_habil_mes"))


def end_dates(
    dates: DataFrame, holidays: DataFrame, rule: str = "today", pad: bool = False
) -> DataFrame:
    """C13 (rules "today", "anchor") and C15 ("two_step"): end date text per `as_of`.

    The two-step form also gives the month name, plain as in the older origin; the later
    text's mask pads it to ten characters, which `pad=True` does.
    """
    if rule == "two_step":
        df = last_business_day_two_step(dates.select("as_of").distinct(), holidays, "d")
        return df.select(
            "as_of",
            yymmdd(F.col("d")).alias("FECHA_FIN"),
            month_name(F.col("d"), pad).alias("NOMBRE_MES"),
        )
    df = dates.select("as_of").distinct().withColumn("a", month_end(F.col("as_of"), -1))
    df = last_business_day(df, "a", holidays, "d", rule)
    return df.select("as_of", yymmdd(F.col("d")).alias("ultimo_dia_mes"))
