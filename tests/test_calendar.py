import datetime as dt

import pytest
from conftest import HOLIDAYS
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mesada import business_calendar, end_date_report, report_calendar, start_date_report
from mesada.functions.dates import add_months_keep_end, dow, month_end, month_name, month_start
from mesada.operators.calendar import (
    as_of_frame,
    first_business_day,
    holiday_or_epoch,
    last_business_day,
)
from mesada.operators.gate import open_months

# as_of, today: first of previous month, first of this month, gate open, last of previous
# month; anchor: the same three days; two-step: start, end.
GOLDEN = """
2024-01-02 2023-12-01 2024-01-02 yes 2023-12-29 2023-12-01 2024-01-02 2023-12-29 2023-12-01 2023-12-29
2024-02-01 2024-01-02 2024-02-01 yes 2024-01-31 2024-01-02 2024-02-01 2024-01-31 2024-01-02 2024-01-30
2024-04-01 2024-03-01 2024-04-01 yes 2024-03-29 2024-03-01 2024-04-01 2024-03-28 2024-03-01 2024-03-28
2024-05-02 2024-04-01 2024-05-02 yes 2024-04-30 2024-04-01 2024-05-02 2024-04-30 2024-04-01 2024-04-29
2024-06-01 2024-05-02 2024-06-04 no 2024-05-31 2024-05-02 2024-06-04 2024-05-31 2024-05-02 2024-05-30
2024-06-03 2024-05-02 2024-06-03 yes 2024-05-31 2024-05-02 2024-06-04 2024-05-31 2024-05-02 2024-05-30
2024-06-04 2024-05-02 2024-06-03 no 2024-05-31 2024-05-02 2024-06-04 2024-05-31 2024-05-02 2024-05-30
2024-07-02 2024-06-03 2024-07-02 yes 2024-06-28 2024-06-04 2024-07-02 2024-06-28 2024-06-04 2024-06-28
2024-09-01 2024-08-01 2024-09-02 no 2024-08-30 2024-08-01 2024-09-02 2024-08-30 2024-08-01 2024-08-30
2024-09-02 2024-08-01 2024-09-02 yes 2024-08-30 2024-08-01 2024-09-02 2024-08-30 2024-08-01 2024-08-30
2024-09-19 2024-08-01 2024-09-02 no 2024-08-30 2024-08-01 2024-09-02 2024-08-30 2024-08-01 2024-08-30
2024-12-02 2024-11-01 2024-12-02 yes 2024-11-29 2024-11-01 2024-12-02 2024-11-29 2024-11-01 2024-11-29
2025-01-02 2024-12-02 2025-01-02 yes 2024-12-31 2024-12-02 2025-01-02 2024-12-31 2024-12-02 2024-12-30
"""
ROWS = [line.split() for line in GOLDEN.strip().splitlines()]


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def dates(spark):
    return as_of_frame(spark, [day(r[0]) for r in ROWS])


def by_date(df, *cols):
    return {r["as_of"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_golden_first_business_days(spark, dates, holidays):
    for rule, cols in (("today", (1, 2)), ("anchor", (5, 6))):
        cal = business_calendar(dates, holidays, rule)
        got = by_date(cal, "primer_dia_habil_mes", "primer_dia_mes")
        assert got == {day(r[0]): tuple(day(r[i]) for i in cols) for r in ROWS}


def test_golden_gate(spark, dates, holidays):
    cal = business_calendar(dates, holidays)
    opened = {r["as_of"] for r in open_months(cal).collect()}
    assert opened == {day(r[0]) for r in ROWS if r[3] == "yes"}
    lagged = {r["as_of"] for r in open_months(cal, 17).collect()}
    assert lagged == {day("2024-09-19")}


def test_golden_last_business_days(spark, dates, holidays):
    for rule, col in (("today", 4), ("anchor", 7)):
        df = dates.withColumn("a", month_end(F.col("as_of"), -1))
        got = by_date(last_business_day(df, "a", holidays, "d", rule), "d")
        assert got == {day(r[0]): (day(r[col]),) for r in ROWS}


def test_golden_two_step_and_date_reports(spark, dates, holidays):
    def yymmdd(text):
        return text[2:].replace("-", "")

    start = by_date(start_date_report(dates, holidays, "two_step"), "FECHA_INICIO")
    assert start == {day(r[0]): (yymmdd(r[8]),) for r in ROWS}
    end = by_date(end_date_report(dates, holidays, "two_step"), "FECHA_FIN", "NOMBRE_MES")
    assert {d: v[0] for d, v in end.items()} == {day(r[0]): yymmdd(r[9]) for r in ROWS}
    assert end[day("2024-02-01")][1] == "Enero"
    first = by_date(start_date_report(dates, holidays), "primer_dia_habil_mes")
    assert first == {day(r[0]): (yymmdd(r[1]),) for r in ROWS}
    last = by_date(end_date_report(dates, holidays), "ultimo_dia_mes")
    assert last == {day(r[0]): (yymmdd(r[4]),) for r in ROWS}
    assert end_date_report(dates, holidays, with_as_of=False).columns == ["ultimo_dia_mes"]


def test_month_names(spark):
    df = spark.sql("select make_date(2024, cast(id as int), 9) d from range(1, 13)")
    got = [r[0] for r in df.orderBy("d").select(month_name(F.col("d"))).collect()]
    assert got[0] == "Enero" and got[8] == "Septiembre" and len(set(got)) == 12
    padded = [r[0] for r in df.select(month_name(F.col("d"), pad=True)).collect()]
    assert {len(x) for x in padded} == {10}


def test_anchors_and_weekday(spark):
    df = spark.sql("select date'2024-03-31' d")
    d = F.col("d")
    row = df.select(
        month_start(d, -1), month_start(d), month_end(d, -1), dow(d),
        add_months_keep_end(F.lit(dt.date(2024, 2, 29)), 1),
        add_months_keep_end(F.lit(dt.date(2024, 1, 30)), 1),
    ).first()
    assert tuple(row) == (
        day("2024-02-01"), day("2024-03-01"), day("2024-02-29"), 1, day("2024-03-31"),
        day("2024-02-29"),
    )


def test_holiday_lookup(spark):
    dates = as_of_frame(spark, [day("2024-01-01"), day("2024-01-02")])
    twice = spark.createDataFrame([(day("2024-01-01"),)] * 2, "fecha date")
    got = by_date(holiday_or_epoch(dates, F.col("as_of"), twice, "h", strict=False), "h")
    assert got == {
        day("2024-01-01"): (day("2024-01-01"),),
        day("2024-01-02"): (day("1900-01-01"),),
    }
    with pytest.raises(Exception, match="more than once"):
        holiday_or_epoch(dates, F.col("as_of"), twice, "h").collect()


def test_unknown_rule(spark, dates, holidays):
    with pytest.raises(ValueError, match="rule"):
        first_business_day(dates.withColumn("a", F.col("as_of")), "a", holidays, "d", "none")


def test_span_of_literal_and_measured_dates(spark, holidays):
    days = [day("2024-02-18"), day("2024-01-03")]
    cal = report_calendar(spark, days, holidays)
    assert (cal.first_month, cal.last_month) == (day("2023-12-01"), day("2024-01-01"))
    frame = as_of_frame(spark, days)
    assert report_calendar(spark, frame, holidays).first_month is None
    measured = report_calendar(spark, frame, holidays, measure_span=True)
    assert (measured.first_month, measured.last_month) == (cal.first_month, cal.last_month)


# -- properties over every day of several years, with random holidays ----------------------

FIRST, DAYS = day("2019-01-01"), 365 * 6


def model_first(anchor, as_of, hol, rule):
    """Brute-force statement of the rule."""
    w = anchor.isoweekday()
    step = {6: 2, 7: 1}.get(w, 0)
    landing = anchor + dt.timedelta(step)
    probe = landing if rule == "anchor" or not step else as_of + dt.timedelta(step)
    if probe in hol and probe == landing:
        return landing + dt.timedelta(3 if landing.isoweekday() == 5 else 1)
    return landing


@settings(
    max_examples=4, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.sets(
        st.integers(0, DAYS).map(lambda n: FIRST + dt.timedelta(n)), min_size=200, max_size=900
    )
)
def test_calendar_matches_model_on_every_day(spark, hol):
    days = spark.sql(f"select date_add(date'{FIRST}', cast(id as int)) as_of from range({DAYS})")
    frame = spark.createDataFrame([(d,) for d in hol], "fecha date")
    for rule in ("today", "anchor"):
        rows = business_calendar(days, frame, rule).collect()
        assert len(rows) == DAYS
        for r in rows:
            for anchor, got in (
                (r["dia_ini_mes"], r["primer_dia_habil_mes"]),
                (r["dia_fin_mes"], r["primer_dia_mes"]),
            ):
                assert got == model_first(anchor, r["as_of"], hol, rule), (rule, r)
            if rule == "today":
                # Q5: an open gate never falls on a weekend.
                assert r["as_of"] != r["primer_dia_mes"] or r["as_of"].isoweekday() < 6
                # Q2: the previous month's weekend start never moves past Monday.
                if r["dia_ini_mes"].isoweekday() > 5:
                    assert r["primer_dia_habil_mes"].isoweekday() == 1


def test_rules_agree_without_weekend_holidays(spark):
    # No holiday on the Monday after a weekend month start: both rules are the same.
    hol = spark.createDataFrame([(d,) for d in HOLIDAYS if d != day("2024-06-03")], "fecha date")
    days = spark.sql("select date_add(date'2024-01-01', cast(id as int)) as_of from range(366)")
    today = business_calendar(days, hol, "today")
    assert today.exceptAll(business_calendar(days, hol, "anchor")).count() == 0
