"""Masks against golden texts, a plain version, and the fixed functions."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from mesada.functions.masks import date_text, number_text, read_number_mask
from mesada.functions.text import grouped_text, money_text, months_text


def texts(spark, values, *masks, dec=".", grp=","):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v decimal(30,6)")
    rows = df.select("k", *[number_text(F.col("v"), m, dec, grp) for m in masks]).orderBy("k").collect()
    return [tuple(r)[1:] for r in rows]


def test_golden_numbers(spark):
    cases = [
        ("999", "12", "  12"), ("999", "-12", " -12"), ("999", "1234", "####"), ("999", "0", "   0"),
        ("FM999", "7", "7"), ("000", "7", " 007"), ("990", "5", "   5"), ("099", "-5", "-005"),
        ("999.99", "0.5", "    .50"), ("990.00", "0.5", "   0.50"), ("FM990.99", "1.5", "1.5"),
        ("FM999.99", "1", "1."), ("FM990.09", "1.5", "1.5"), ("FM990.00", "1.5", "1.50"),
        ("9,999", "123", "   123"), ("9,999", "1234", " 1,234"), ("0,000", "12", " 0,012"),
        ("FM9G999G990D00", "1234567.891", "1,234,567.89"), ("$9,990.00", "-1234.5", "-$1,234.50"),
        ("FM99,99,990", "1234567", "12,34,567"), ("999", "999.5", "####"), ("FM999", "-0.4", "0"),
        ("FM999,999,999,999", "1500.6", "1,501"),
    ]
    for mask, value, want in cases:
        assert texts(spark, [D(value)], mask) == [(want,)], mask
    assert texts(spark, [None], "999", "FM9.9") == [(None, None)]
    assert texts(spark, [D("1234.5")], "FM9G990D00", dec=",", grp=".") == [("1.234,50",)]
    assert texts(spark, [D("1234.5")], "FM9G990D00", dec=",", grp="") == [("1234,50",)]


@pytest.mark.parametrize("mask", ["", "FM", "A9", "9,", ",9", "9..9", "9,,9", "99.9.9", "YYYY"])
def test_other_masks_are_refused(mask):
    with pytest.raises(ValueError, match="mask"):
        read_number_mask(mask)


def plain(v, mask):
    """A number by its mask, character by character."""
    if v is None:
        return None
    compact, body = mask.startswith("FM"), mask.removeprefix("FM")
    whole, _, part = body.partition(".")
    digits = whole.replace(",", "")
    v = v.quantize(D(1).scaleb(-len(part)), ROUND_HALF_UP)
    width = len(body) + 1
    if abs(v) >= 10 ** len(digits):
        return "#" * width
    shown = f"{abs(v):.{len(part)}f}".partition(".")
    text = shown[0].rjust(len(digits))
    first = digits.find("0")
    out, seen = "", False
    k = 0
    for mark in whole:
        if mark == ",":
            out += "," if seen else ""
            continue
        d = text[k]
        if d == "0" and not seen and int(shown[0]) == 0 and k == len(digits) - 1 and part and first < 0:
            d = " "
        if d == " " and 0 <= first <= k:
            d = "0"
        seen = seen or d != " "
        out += d.strip()
        k += 1
    if part:
        decimals = shown[2]
        if compact:
            keep = part.rfind("0") + 1
            decimals = decimals[:keep] + decimals[keep:].rstrip("0")
        out += "." + decimals
    out = ("-" if v < 0 else "") + out
    return out if compact else out.rjust(width)


def test_masks_against_a_plain_version(spark):
    rnd = random.Random(5)
    masks = []
    for _ in range(24):
        n, at = rnd.randrange(1, 12), rnd.randrange(13)
        whole = "".join("0" if k >= at else "9" for k in range(n))
        if n > 3 and rnd.random() < 0.6:
            cut = rnd.randrange(1, n)
            whole = whole[:cut] + "," + whole[cut:]
        part = rnd.choice(["", ".9", ".99", ".00", ".09", ".990"])
        masks.append(rnd.choice(["", "FM"]) + whole + part)
    values = [None, D(0)] + [
        D(rnd.randrange(-10**9, 10**9)) / 10 ** rnd.randrange(7) for _ in range(150)
    ]
    for row, v in zip(texts(spark, values, *masks), values, strict=True):
        assert list(row) == [plain(v, m) for m in masks], v


def test_fixed_functions_are_masks(spark):
    rnd = random.Random(6)
    values = [None, D(0), D("999.5"), D(10**15), D("-999999999999999.995")] + [
        D(rnd.randrange(-10**8, 10**8)) / 100 for _ in range(200)
    ]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(24,3)")
    v = F.col("v")
    money = "FM999G999G999G999G990D00"
    for r in df.select(
        grouped_text(v), number_text(v, "FM999,999,999,999"),
        money_text(v), number_text(F.coalesce(v, F.lit(0)), money, ",", ""),
        money_text(v, ".", ","), number_text(F.coalesce(v, F.lit(0)), money),
        months_text(F.abs(v)), F.lpad(F.trim(number_text(F.abs(v), "999")), 3, "0"),
    ).collect():
        assert r[0] == r[1] and r[2] == r[3] and r[4] == r[5]
        assert r[6] == (r[7] if r[7] is None or "#" not in r[7] else "###")


def test_dates(spark):
    days = [dt.datetime(2024, 9, 1, 7, 5, 9), dt.datetime(1999, 12, 31, 23, 59, 0), None]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp")
    cases = {
        "YYMMDD": "%y%m%d", "DD/MM/YYYY": "%d/%m/%Y", "YYYYMM": "%Y%m", "HH24": "%H",
        'YYYY-MM-DD"T"HH24:MI:SS': "%Y-%m-%dT%H:%M:%S",
    }
    rows = df.select(*[date_text(F.col("d"), m) for m in cases]).collect()
    for row, d in zip(rows, days, strict=True):
        assert list(row) == [None if d is None else d.strftime(f) for f in cases.values()]
    masks = ["D", "MONTH", "Month", "FMMonth DD", "mon", "FMDD/MM"]
    first, second, _ = df.select(*[date_text(F.col("d"), m) for m in masks]).collect()
    assert tuple(first) == ("1", "SEPTIEMBRE", "Septiembre", "Septiembre 1", "sep", "1/9")
    assert tuple(second) == ("6", "DICIEMBRE ", "Diciembre ", "Diciembre 31", "dic", "31/12")
    with pytest.raises(ValueError, match="not understood at 'Q'"):
        date_text(F.col("d"), "YYYYQ")
