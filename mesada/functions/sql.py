"""The two stored functions for SQL text, as SQL functions that Spark inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from mesada.functions.text import MONEY_OVERFLOW

# The value type keeps ten decimals, so that rounding happens once, in the body.
_VALUE = "DECIMAL(38,10)"

FORMAT_MONEY = f"""
CREATE OR REPLACE TEMPORARY FUNCTION formatmoney(
  valor {_VALUE}, longitud INT DEFAULT 30, prefijo STRING DEFAULT NULL,
  sufijo STRING DEFAULT NULL, sep_decimal STRING DEFAULT ',', sep_miles STRING DEFAULT NULL)
RETURNS STRING
RETURN lpad(concat_ws('', prefijo,
  CASE WHEN abs(round(coalesce(valor, 0), 2)) >= 1000000000000000 THEN '{MONEY_OVERFLOW}'
    ELSE replace(replace(
      translate(format_number(round(coalesce(valor, 0), 2), 2), ',.', '\u0001\u0002'),
      '\u0001', coalesce(sep_miles, '')), '\u0002', coalesce(nullif(sep_decimal, ''), ','))
  END, sufijo), longitud, ' ')
"""



def _fixed(d: int) -> str:
    """`text.fixed_number_text` for d decimals, in SQL."""
    v = f"round(coalesce(valor, 0), {d})"
    whole = f"greatest(longitud - {d + 1}, 1)"
    digits = f"lpad(replace(format_number(abs({v}), {d}), ',', ''), {whole} + {d + 1}, '0')"
    return (
        f"lpad(CASE WHEN abs({v}) >= CAST(power(10, {whole}) AS DECIMAL(38,0))"
        f" THEN repeat('#', longitud)"
        f" ELSE concat(CASE WHEN {v} < 0 THEN '-' ELSE '' END, {digits}) END, longitud, '0')"
    )


# One branch for each number of decimals the value type holds: ROUND needs a constant.
FIXED = "CASE decimales " + " ".join(f"WHEN {d} THEN {_fixed(d)}" for d in range(1, 11))
FIXED += " ELSE raise_error('format_number_padded: at most ten decimals') END"

FORMAT_NUMBER = f"""
CREATE OR REPLACE TEMPORARY FUNCTION format_number_padded(
  valor {_VALUE}, mascara STRING DEFAULT NULL, longitud INT DEFAULT 10,
  decimales INT DEFAULT 0)
RETURNS STRING
RETURN CASE WHEN coalesce(decimales, 0) <= 0
  THEN lpad(CAST(CAST(coalesce(valor, 0) AS BIGINT) AS STRING), longitud, '0')
  ELSE {FIXED} END
"""


def create_sql_functions(spark: SparkSession) -> None:
    """`formatmoney` (F17) and `format_number_padded` (F18) for this session.

    The second has another name than the original's format_number, which is a Spark
    built-in; with a fourth parameter it is `text.fixed_number_text` in its right width.
    """
    spark.sql(FORMAT_MONEY)
    spark.sql(FORMAT_NUMBER)
