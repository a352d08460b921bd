"""Numbers and money as text, built from native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The text a number mask prints when the value does not fit
# (one character more than the mask, for the sign).
MONEY_OVERFLOW = "#" * 23
GROUPED_OVERFLOW = "#" * 16
MONTHS_OVERFLOW = "#" * 4


def nvl(x: Column, default) -> Column:
    """first non-null value."""
    return F.coalesce(x, default if isinstance(default, Column) else F.lit(default))


def concat_text(*parts: Column, null_concat: bool = False) -> Column:
    """concatenation in which NULL counts as empty, or propagates with `null_concat`."""
    return F.concat(*parts) if null_concat else F.concat_ws("", *parts)


def without(x: Column, token: str) -> Column:
    """remove every occurrence of a literal token."""
    return F.replace(x, F.lit(token), F.lit(""))


def num_text(x: Column) -> Column:
    """shortest decimal text, no trailing zeros and no zero before the point.

    Each branch makes one text: reports use this many times per row, and a repeated
    sub-expression would be generated, and run, once per mention.
    """
    whole = F.floor(x)
    sign = F.when(x < 0, "-").otherwise("")
    # A value with a fraction has a point, so only zeros of the fraction end its text.
    digits = F.ltrim(F.rtrim(F.abs(x).cast("string"), F.lit("0")), F.lit("0"))
    return F.when(F.ceil(x) == whole, whole.cast("string")).otherwise(F.concat(sign, digits))


def money_text(
    x: Column,
    dec: str | None = ",",
    grp: str | None = "",
    width: int | None = None,
    prefix: str = "",
    suffix: str = "",
) -> Column:
    """two decimals, NULL as zero, at most 15 integer digits.

    `width` pads (and cuts) on the left; the reports strip that padding, so it is
    off by default. `grp` None or '' means no grouping (E3).
    """
    dec = dec or ","
    v = F.round(nvl(x, 0), 2)
    if grp:
        # Through private marks, so that dec and grp may swap '.' and ','.
        body = F.replace(
            F.replace(
                F.translate(F.format_number(v, 2), ",.", "\u0001\u0002"),
                F.lit("\u0001"),
                F.lit(grp),
            ),
            F.lit("\u0002"),
            F.lit(dec),
        )
    else:
        body = F.replace(v.cast("decimal(38,2)").cast("string"), F.lit("."), F.lit(dec))
    body = F.when(F.abs(v) >= F.lit(10**15), F.lit(MONEY_OVERFLOW)).otherwise(body)
    if prefix or suffix:
        body = F.concat(F.lit(prefix), body, F.lit(suffix))
    return F.lpad(body, width, " ") if width else body


def grouped_text(x: Column) -> Column:
    """whole units grouped by comma, NULL stays NULL, at most 12 digits."""
    v = F.round(x, 0).cast("decimal(38,0)")
    return F.when(F.abs(v) >= F.lit(10**12), F.lit(GROUPED_OVERFLOW)).otherwise(
        F.format_number(v, 0)
    )


def money(x: Column, style: str) -> Column:
    return grouped_text(x) if style == "grouped" else money_text(x)


def zero_pad(x: Column, length: int) -> Column:
    """whole part, NULL as zero, left-padded with zeros and cut to `length`."""
    return F.lpad(nvl(x, 0).cast("bigint").cast("string"), length, "0")


def fixed_number_text(x: Column, length: int, decimals: int, strict: bool = False) -> Column:
    """zero-padded number with decimals.

    `strict` keeps the known fault of the original: its digits fill one character
    more than `length`, so the last decimal is cut. The default has the right width.
    """
    if decimals <= 0:
        return zero_pad(x, length)
    whole = max(length - decimals - 1, 1) + (1 if strict else 0)
    v = F.round(nvl(x, 0), decimals).cast(f"decimal(38,{decimals})")
    digits = F.lpad(F.abs(v).cast("string"), whole + 1 + decimals, "0")
    body = F.when(F.abs(v) >= F.lit(10**whole), F.lit("#" * length)).otherwise(
        F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), digits)
    )
    return F.lpad(body, length, "0")


def months_text(x: Column) -> Column:
    """F16: number of months on three digits, NULL stays NULL (draft)."""
    v = F.round(x, 0).cast("bigint")
    body = F.when(F.abs(v) >= 1000, F.lit(MONTHS_OVERFLOW)).otherwise(v.cast("string"))
    return F.lpad(body, 3, "0")


def term_code(unit: Column, n: Column, style: str = "plain", null_concat: bool = False) -> Column:
    """Unit digit followed by the number of instalments."""
    # M = months, A = years, anything else 0.
    digit = F.when(unit == "M", "2").when(unit == "A", "3").otherwise("0")
    number = months_text(n) if style == "grouped" else zero_pad(n, 3)
    return concat_text(digit, number, null_concat=null_concat)


def dollar(text: Column, null_concat: bool = False) -> Column:
    """B4, B5: '$' in front; a NULL number leaves the sign alone."""
    return concat_text(F.lit("$"), text, null_concat=null_concat)


def cut(x: Column, length: int) -> Column:
    """text limited to `length` characters."""
    return F.substring(x, 1, length)


def empty_to_null(df: DataFrame) -> DataFrame:
    """E1: '' becomes NULL in every string column."""
    return df.selectExpr(
        *[
            f"nullif(`{f.name}`, '') AS `{f.name}`"
            if isinstance(f.dataType, StringType)
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )
