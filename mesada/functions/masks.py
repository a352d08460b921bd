"""Number and date masks as column expressions.

A mask is read once, when the report is built; what comes out is an ordinary expression, with
the origin's rules of rounding, padding and overflow.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from mesada.functions.dates import MONTH_NAMES


@dataclass(frozen=True)
class NumberMask:
    """Elements of a number mask; positions count digits from the decimal point."""

    compact: bool  # FM: no blanks around, no optional zeros behind the point
    dollar: bool
    digits: int  # before the point
    forced: int  # of them, shown even as zeros
    decimals: int
    forced_decimals: int
    groups: tuple[int, ...]  # digits to the right of each separator, from the left

    @property
    def width(self) -> int:
        """Characters of a padded text: the mask's, and one for the sign."""
        point = 1 if self.decimals else 0
        return self.digits + len(self.groups) + point + self.decimals + self.dollar + 1


def read_number_mask(mask: str) -> NumberMask:
    """FM, $, digits 9 and 0, separators `,` or G, point `.` or D; anything else is refused."""
    found = re.fullmatch(r"(FM)?(\$)?([90][90,G]*)(?:[.D]([90]*))?", mask, re.IGNORECASE)
    if not found:
        raise ValueError(f"number mask {mask!r} is not understood")
    compact, dollar, whole, part = found.groups()
    whole, part = re.sub("[gG]", ",", whole), part or ""
    digits = whole.replace(",", "")
    groups = [len(rest.replace(",", "")) for rest in _tails(whole)]
    if 0 in groups or len(set(groups)) < len(groups):
        raise ValueError(f"number mask {mask!r}: a separator needs digits on both sides")
    return NumberMask(
        compact is not None,
        dollar is not None,
        len(digits),
        len(digits) - digits.index("0") if "0" in digits else 0,
        len(part),
        part.rindex("0") + 1 if "0" in part else 0,
        tuple(groups),
    )


def _tails(whole: str) -> list[str]:
    """What stands behind each separator."""
    return [whole[k + 1 :] for k, mark in enumerate(whole) if mark == ","]


def number_text(x: Column, mask: str, dec: str = ".", grp: str = ",") -> Column:
    """A number by its mask: rounded half up, NULL stays NULL, `#` where it does not fit.

    Zeros before the point show from the mask's first 0 on, else as blanks; a separator shows
    where a digit stands before it. Without FM the text is padded on the left to the mask's
    width and one for the sign. `dec` and `grp` stand for point and separator, and may be ''.
    """
    m = read_number_mask(mask)
    v = F.round(x, m.decimals).cast(f"decimal(38,{m.decimals})")
    body = _grouped(F.abs(v), m, dec, grp)
    if m.compact and m.decimals > m.forced_decimals:
        body = _without_zeros(body, m, dec)
    if m.dollar:
        body = F.concat(F.lit("$"), body)
    body = F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), body)
    if not m.compact:
        body = F.lpad(body, m.width, " ")
    too_long = F.abs(v) >= F.lit(10**m.digits).cast("decimal(38,0)")
    return F.when(too_long, F.lit("#" * m.width)).otherwise(body)


def _grouped(v: Column, m: NumberMask, dec: str, grp: str) -> Column:
    """The digits of a value that is not negative, with separators and decimals."""
    places = m.decimals
    text = v.cast("string")
    whole = F.substring_index(text, ".", 1) if places else text
    if not m.forced and places:
        whole = F.when(whole == "0", F.lit("")).otherwise(whole)
    if m.forced > 1:
        whole = F.lpad(whole, F.greatest(F.length(whole), F.lit(m.forced)), F.lit("0"))
    if m.groups and grp:
        parts, left = [], m.digits
        padded = F.lpad(whole, m.digits, " ")
        for right in m.groups:
            parts.append(F.substring(padded, m.digits - left + 1, left - right))
            parts.append(F.when(F.length(whole) > right, F.lit(grp)).otherwise(F.lit("")))
            left = right
        parts.append(F.substring(padded, m.digits - left + 1, left))
        whole = F.ltrim(F.concat(*parts))
    return F.concat(whole, F.lit(dec), F.substring_index(text, ".", -1)) if places else whole


def _without_zeros(body: Column, m: NumberMask, dec: str) -> Column:
    """Decimals beyond the forced ones lose their zeros at the end; the point stays."""
    optional = m.decimals - m.forced_decimals
    kept = F.substring(body, F.lit(1), F.length(body) - optional)
    return F.concat(kept, F.rtrim(F.right(body, F.lit(optional)), F.lit("0")))


_DATE_TOKEN = re.compile(
    r'(?P<text>"[^"]*")|(?P<part>YYYY|YY|MM|DDD|DD|HH24|HH12|HH|MI|SS|D)|(?P<month>MONTH|MON)'
    r"|(?P<mark>[^A-Z0-9\"]+)",
    re.IGNORECASE,
)
# The marks of masks and what Spark's patterns call them.
_PARTS = {
    "YYYY": "yyyy", "YY": "yy", "MM": "MM", "DDD": "DDD", "DD": "dd", "HH24": "HH", "HH12": "hh",
    "HH": "hh", "MI": "mm", "SS": "ss",
}


def date_text(d: Column, mask: str) -> Column:
    """A date or time by its mask; Spanish month names in the case of the mask.

    MONTH is padded with blanks to the longest name unless FM stands first; D counts weekdays
    from Sunday, 1, whatever the session's territory.
    """
    compact = mask[:2].upper() == "FM"
    rest, at, parts = mask[2:] if compact else mask, 0, []
    while at < len(rest):
        found = _DATE_TOKEN.match(rest, at)
        if not found:
            raise ValueError(f"date mask {mask!r} is not understood at {rest[at:]!r}")
        at, token = found.end(), found[0]
        if found["text"] or found["mark"]:
            parts.append(F.lit(token.strip('"') if found["text"] else token))
        elif found["month"]:
            parts.append(_month(d, token, compact))
        elif token.upper() == "D":
            parts.append(F.dayofweek(d).cast("string"))
        else:
            made = F.date_format(d, _PARTS[token.upper()])
            number = compact and token.upper() not in ("YYYY", "YY")
            parts.append(made.cast("int").cast("string") if number else made)
    return F.concat(*parts)


def _month(d: Column, token: str, compact: bool) -> Column:
    size = 3 if len(token) == 3 else None
    names = [n[:size] for n in MONTH_NAMES]
    if token.isupper():
        names = [n.upper() for n in names]
    elif token[0].isupper():
        names = [n.capitalize() for n in names]
    name = F.element_at(F.array(*map(F.lit, names)), F.month(d))
    return name if compact or size else F.rpad(name, max(map(len, names)), " ")
