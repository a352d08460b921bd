"""Totals from stored partial sums: equal to the full run, and only changed months are read."""

import datetime as dt
import re

import pytest
from report_fixture import relations, rows
from test_plans import plan

from mesada import disbursement_totals, report_calendar, transfer_totals
from mesada.plans.parts import (
    DISBURSEMENT,
    TRANSFER,
    partial_totals,
    totals_from_parts,
    write_partial_totals,
)
from mesada.sources.writers import MONTH_COLUMN, write_by_month

FULL = {DISBURSEMENT: disbursement_totals, TRANSFER: transfer_totals}
MONTHS = [dt.date(2023 + (k // 12), k % 12 + 1, 1) for k in range(18)]
DAYS = [d for m in MONTHS for d in (m, m.replace(day=18), m.replace(day=2), m.replace(day=19))]


def sendings(extra=()):
    out = []
    for k, month in enumerate(MONTHS):
        for j, hour in enumerate(("08:15", "12:00", "10:30", "14:30")):
            day = month.replace(day=1 + (5 * j + k) % 9)
            out.append((101 + (3 * k + j) % 9, f"{day} {hour}", (1, 6, 7, 2)[(k + j) % 4], 1, str(1000 * k + j)))
    return [*out, *extra]


def tables(spark, extra=(), path=None):
    t = dict(relations(spark, rows(extra_sendings=sendings(extra), duplicate_lines=(101, 104))))
    if path is not None:
        write_by_month(t["desembolsorelacion"], str(path), "fechaenvio")
        t["desembolsorelacion"] = spark.read.parquet(str(path))
    return t


def result(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("report", [DISBURSEMENT, TRANSFER])
def test_a_changed_month_alone_is_read(spark, holidays, tmp_path, report):
    profile = "v1" if report == DISBURSEMENT else "v2"
    cal = report_calendar(spark, DAYS, holidays)
    path = str(tmp_path / "parts")
    t = tables(spark, path=tmp_path / "a")
    write_partial_totals(t, path, report, profile, month_col=MONTH_COLUMN)
    full = FULL[report](t, cal, profile)
    assert result(totals_from_parts(spark, path, cal, report, profile)) == result(full)
    assert len({r["as_of"]: r for r in full.collect()}) == len(set(DAYS))

    # March gets more sendings; so does May, which is not named and must stay as it was.
    march, may = dt.date(2023, 3, 1), dt.date(2023, 5, 1)
    more = [(103, "2023-03-01 08:00", 1, 1, "77"), (104, "2023-03-02 12:30", 6, 1, "-5.5")]
    late = [(103, "2023-05-02 08:00", 1, 1, "99")]
    changed = tables(spark, more, tmp_path / "b")
    both = tables(spark, [*more, *late], tmp_path / "c")
    text = plan(partial_totals(both, report, profile, [march], MONTH_COLUMN))
    assert re.search(r"PartitionFilters: \[.*envio_mes#\d+ = 2023-03-01", text)
    assert "GreaterThanOrEqual(fechaenvio,2023-03-01T00:00)" in text
    write_partial_totals(both, path, report, profile, [march], MONTH_COLUMN)
    assert result(totals_from_parts(spark, path, cal, report, profile)) == result(
        FULL[report](changed, cal, profile)
    )
    write_partial_totals(both, path, report, profile, [may.replace(day=9)], MONTH_COLUMN)
    assert result(totals_from_parts(spark, path, cal, report, profile)) == result(
        FULL[report](both, cal, profile)
    )
    # A month whose sendings are gone loses its sums.
    empty = dict(both)
    empty["desembolsorelacion"] = both["desembolsorelacion"].where("envio_mes <> DATE '2023-03-01'")
    write_partial_totals(empty, path, report, profile, [march], MONTH_COLUMN)
    assert result(totals_from_parts(spark, path, cal, report, profile)) == result(
        FULL[report](empty, cal, profile)
    )
    write_partial_totals(empty, path, report, profile, [], MONTH_COLUMN)  # nothing named


def test_only_the_months_of_the_calendar_are_read(spark, holidays, tmp_path):
    t = tables(spark)
    path = str(tmp_path / "parts")
    write_partial_totals(t, path, TRANSFER, "v1")
    cal = report_calendar(spark, [dt.date(2024, 2, 1)], holidays)
    df = totals_from_parts(spark, path, cal, TRANSFER, "v1", with_as_of=False)
    assert re.search(r"PartitionFilters: \[.*mes#\d+.*2024-01-01", plan(df))
    assert result(df) == result(transfer_totals(t, cal, "v1", with_as_of=False))


def test_sums_that_are_null_stay_null(spark, holidays, tmp_path):
    # The unguarded total of requests whose lines have no amount.
    lines = [(i, f"NC{i}", "CC", f"900{i}", None, 1) for i in range(101, 111)]
    t = dict(relations(spark, rows(lines=lines)))
    assert t["desembolso"].first()["montoDesembolsar"] is None
    write_partial_totals(t, str(tmp_path / "p"), DISBURSEMENT, "v2")
    cal = report_calendar(spark, [dt.date(2024, 2, 1)], holidays)
    want = disbursement_totals(t, cal, "v2")
    assert result(totals_from_parts(spark, str(tmp_path / "p"), cal, DISBURSEMENT, "v2")) == result(want)
