"""Month anchors, weekday numbers and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday numbers, as dayofweek() gives them.
SUNDAY, MONDAY, FRIDAY, SATURDAY = 1, 2, 6, 7

# Month names.
MONTH_NAMES = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
)


def month_start(d: Column, shift: int = 0) -> Column:
    """First day of the month `shift` months away."""
    return F.trunc(F.add_months(d, shift), "MM")


def month_end(d: Column, shift: int = 0) -> Column:
    """Last day of the month `shift` months away."""
    return F.last_day(F.add_months(d, shift))


def dow(d: Column) -> Column:
    """C4: 1 = Sunday ... 7 = Saturday, whatever the session locale."""
    return F.dayofweek(d)


def add_months_keep_end(d: Column, n: int) -> Column:
    """Month shift that maps a last day of month to a last day of month."""
    shifted = F.add_months(d, n)
    return F.when(d == F.last_day(d), F.last_day(shifted)).otherwise(shifted)


def yymmdd(d: Column) -> Column:
    return F.date_format(d, "yyMMdd")


def ddmmyyyy(d: Column) -> Column:
    return F.date_format(d, "dd/MM/yyyy")


def yyyymm(d: Column) -> Column:
    return F.date_format(d, "yyyyMM")


def month_name(d: Column, pad: bool = False) -> Column:
    """capitalised Spanish month name, blank-padded to the longest with `pad`."""
    name = F.initcap(F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(d)))
    return F.rpad(name, max(map(len, MONTH_NAMES)), " ") if pad else name
