"""Queries on the driver's tables, one or more per operator family, with their check SQL."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from analogue import oracle as o
from analogue.relations import DATES, SQL, derived, duck, holidays, relations, run, table
from mesada import (
    disbursement_detail,
    disbursement_totals,
    end_date_report,
    report_calendar,
    start_date_report,
    transfer_detail,
    transfer_totals,
)
from mesada.functions import labels, text
from mesada.functions.cutoff import cutoff_label
from mesada.functions.masks import date_text, number_text
from mesada.functions.sql import create_sql_functions
from mesada.functions.dates import (
    MONTH_NAMES,
    add_months_keep_end,
    ddmmyyyy,
    month_name,
    yymmdd,
    yyyymm,
)
from mesada.operators.calendar import business_calendar, holiday_or_epoch, last_business_day
from mesada.operators.distinct import distinct_rows
from mesada.operators.gate import cutoff_filter, month_gate, type_filter, weekday_guard
from mesada.operators.lookups import bridge_lookup, lookup
from mesada.operators.ordering import order_by_ordinal
from mesada.operators.ranked import fold_fixed, fold_ranked, ranked_children, ranked_fold
from mesada.operators.totals import positional, totals_per_date, weighted_sum
from mesada.plans.parts import DISBURSEMENT, TRANSFER, totals_from_parts, write_partial_totals
from mesada.profiles import PROFILES, get_profile
from mesada.sources.pushdown import only_keys, pushed_relations
from mesada.sources.writers import read_report_file, write_by_month, write_report_file

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

c = F.col

ORDER_DATES = "SELECT CAST(o_orderdate AS DATE) AS as_of FROM {orders}"
EVENTS_AS_OF = dt.date(2024, 2, 1)


def comparable(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as double: types that every client reads alike."""
    out = []
    for f in df.schema.fields:
        col = f"`{f.name}`"
        if isinstance(f.dataType, DateType):
            col = f"date_format({col}, 'yyyy-MM-dd')"
        elif isinstance(f.dataType, DecimalType):
            col = f"CAST({col} AS DOUBLE)"
        out.append(f"{col} AS `{f.name}`")
    return df.selectExpr(*out)


def query(name: str, sql: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(fn(spark, sf_dir))
        ORACLE[name] = sql
        return fn

    return register


def iso(d: str) -> str:
    return f"strftime({d}, '%Y-%m-%d')"


def order_dates(spark, sf_dir):
    return run(spark, sf_dir, ORDER_DATES).distinct()


def backfill_calendar(spark, sf_dir, rule="today"):
    return report_calendar(spark, run(spark, sf_dir, DATES), holidays(spark), rule)


# -- calendar -----------------------------------------------------------------------------


def _calendar_sql(rule: str) -> str:
    return (
        o.ctes(o.HOL, o.dates(ORDER_DATES), o.calendar(rule))
        + f"""SELECT {iso("as_of")} AS as_of, CAST(dow_hoy AS INT) AS dow_hoy,
  {iso("ini")} AS dia_ini_mes, {iso("fin")} AS dia_fin_mes, {iso("habil")} AS primer_dia_habil_mes,
  {iso("abre")} AS primer_dia_mes, {o.ymd("habil")} AS habil_txt, as_of = abre AS abierto FROM cal"""
    )


def _calendar(rule):
    def fn(spark, sf_dir):
        cal = business_calendar(order_dates(spark, sf_dir), holidays(spark), rule)
        return cal.select(
            "*",
            yymmdd(c("primer_dia_habil_mes")).alias("habil_txt"),
            (c("as_of") == c("primer_dia_mes")).alias("abierto"),
        )

    return fn


query("calendar_first_business_day", _calendar_sql("today"))(_calendar("today"))
query("calendar_anchor_rule", _calendar_sql("anchor"))(_calendar("anchor"))


@query(
    "calendar_last_business_day",
    o.ctes(o.HOL, o.dates(ORDER_DATES), f"a AS (SELECT as_of, {o.PREV_END} AS m FROM dates)")
    + f"""SELECT {iso("as_of")} AS as_of, {iso("m")} AS m, {iso(o.last_day("m", "today"))} AS hoy,
  {iso(o.last_day("m", "anchor"))} AS ancla FROM a""",
)
def _last_business_day(spark, sf_dir):
    hol = holidays(spark)
    df = order_dates(spark, sf_dir).withColumn("m", F.last_day(F.add_months("as_of", -1)))
    df = last_business_day(df, "m", hol, "hoy", "today")
    return last_business_day(df, "m", hol, "ancla", "anchor")


@query(
    "start_date_report",
    o.ctes(o.HOL, o.dates(ORDER_DATES), o.calendar("today"))
    + f"SELECT {iso('as_of')} AS as_of, {o.ymd('habil')} AS primer_dia_habil_mes FROM cal",
)
def _start_date(spark, sf_dir):
    return start_date_report(order_dates(spark, sf_dir), holidays(spark))


@query(
    "end_date_report",
    o.ctes(o.HOL, o.dates(ORDER_DATES), f"a AS (SELECT as_of, {o.PREV_END} AS m FROM dates)")
    + f"""SELECT {iso("as_of")} AS as_of, {o.ymd(o.last_day("m", "today"))} AS ultimo_dia_mes
FROM a""",
)
def _end_date(spark, sf_dir):
    return end_date_report(order_dates(spark, sf_dir), holidays(spark))


# Month names as printed.
_MONTHS = (
    "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre',"
    "'Octubre','Noviembre','Diciembre']"
)


@query(
    "calendar_two_step_start",
    o.ctes(
        o.HOL,
        o.dates(ORDER_DATES),
        f"a AS (SELECT as_of, {o.PREV2_END} AS m FROM dates)",
        """b AS (SELECT as_of, m + CASE isodow(m) WHEN 6 THEN 2 WHEN 5 THEN 3 ELSE 1 END AS s
FROM a)""",
    )
    + f"""SELECT {iso("as_of")} AS as_of,
  {o.ymd("s + CASE WHEN s IN (SELECT fecha FROM diasfestivos) THEN 1 ELSE 0 END")} AS FECHA_INICIO
FROM b""",
)
def _two_step_start(spark, sf_dir):
    return start_date_report(order_dates(spark, sf_dir), holidays(spark), "two_step")


@query(
    "calendar_two_step_end",
    o.ctes(
        o.HOL,
        o.dates(ORDER_DATES),
        f"a AS (SELECT as_of, {o.PREV_END} AS m FROM dates)",
        """b AS (SELECT as_of, m - CASE isodow(m) WHEN 7 THEN 2 WHEN 1 THEN 3 ELSE 1 END AS s
FROM a)""",
        """e AS (SELECT as_of,
  s - CASE WHEN s IN (SELECT fecha FROM diasfestivos) THEN 1 ELSE 0 END AS f FROM b)""",
    )
    + f"""SELECT {iso("as_of")} AS as_of, {o.ymd("f")} AS FECHA_FIN,
  rpad({_MONTHS}[month(f)], 10, ' ') AS NOMBRE_MES FROM e""",
)
def _two_step_end(spark, sf_dir):
    return end_date_report(order_dates(spark, sf_dir), holidays(spark), "two_step", pad=True)


@query(
    "holiday_scalar_subquery",
    o.ctes(o.HOL, o.dates(ORDER_DATES))
    + f"""SELECT {iso("d.as_of")} AS as_of,
  {iso("coalesce((SELECT fecha FROM diasfestivos WHERE fecha = d.as_of + 2), DATE '1900-01-01')")}
    AS festivo FROM dates d""",
)
def _holiday_lookup(spark, sf_dir):
    dates = order_dates(spark, sf_dir)
    return holiday_or_epoch(dates, F.date_add("as_of", 2), holidays(spark), "festivo")


@query(
    "date_text",
    f"""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT {iso("d")} AS d, strftime(d, '%d/%m/%Y') AS dmy, strftime(d, '%Y%m') AS ym,
  {o.ymd("d")} AS ymd, {_MONTHS}[month(d)] AS mes,
  CASE WHEN d = last_day(d) THEN {iso("last_day(d + INTERVAL 1 MONTH)")}
       ELSE {iso("d + INTERVAL 1 MONTH")} END AS mas_un_mes,
  {iso("date_trunc('week', d)")} AS lunes FROM d""",
)
def _date_text(spark, sf_dir):
    d = c("d")
    return (
        table(spark, sf_dir, "orders")
        .select(c("o_orderdate").cast("date").alias("d"))
        .distinct()
        .select(
            "d",
            ddmmyyyy(d).alias("dmy"),
            yyyymm(d).alias("ym"),
            yymmdd(d).alias("ymd"),
            month_name(d).alias("mes"),
            add_months_keep_end(d, 1).alias("mas_un_mes"),
            F.trunc(d, "WEEK").alias("lunes"),
        )
    )


# -- batches and gate ---------------------------------------------------------------------

_CUTOFF_SQL = f"""WITH e AS (SELECT {o.label("ts")} AS corte, value FROM events)
SELECT corte, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM e GROUP BY corte"""


@query("cutoff_label", _CUTOFF_SQL)
def _cutoff_label(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return (
        events.select(cutoff_label(c("ts")).alias("corte"), c("value").cast("decimal(18,2)"))
        .groupBy("corte")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    )


def _one_date(d: dt.date) -> str:
    return f"SELECT DATE '{d}' AS as_of"


def _gated_events_sql(op: str, days: list[dt.date], lag: int, guard: bool, cols: str) -> str:
    base = f"AND {o.label('e.ts')} {op} a.base" if op else ""
    return (
        o.ctes(
            o.HOL,
            o.dates(" UNION ".join(map(_one_date, days))),
            o.calendar("today"),
            o.gate(lag, guard),
        )
        + f"""SELECT {cols} FROM events e JOIN abiertos a ON strftime(e.ts, '%Y%m') = a.mes {base}"""
    )


_FLAGSHIP_COLS = f"""DISTINCT {iso("a.as_of")} AS as_of, e.user_id, e.event_type,
  {o.label("e.ts")} AS corte"""


def _flagship(op):
    def fn(spark, sf_dir):
        cal = report_calendar(spark, [EVENTS_AS_OF], holidays(spark))
        events = table(spark, sf_dir, "events").select("ts", "user_id", "event_type")
        gated = month_gate(events, cal, "ts", guard=True, cutoff_op=op)
        return distinct_rows(gated.select("as_of", "user_id", "event_type", "corte"))

    return fn


query(
    "flagship_cutoff_v1", _gated_events_sql("=", [EVENTS_AS_OF], 0, True, _FLAGSHIP_COLS)
)(_flagship("="))
query("cutoff_v2", _gated_events_sql(">", [EVENTS_AS_OF], 0, True, _FLAGSHIP_COLS))(
    _flagship(">")
)


_LAG_DAYS = [EVENTS_AS_OF, dt.date(2024, 2, 18)]


@query(
    "month_gate_lag17",
    _gated_events_sql("", _LAG_DAYS, 17, False, f"{iso('a.as_of')} AS as_of, e.event_id"),
)
def _lag17(spark, sf_dir):
    cal = report_calendar(spark, _LAG_DAYS, holidays(spark))
    events = table(spark, sf_dir, "events").select("ts", "event_id")
    return month_gate(events, cal, "ts", lag_days=17).select("as_of", "event_id")


@query(
    "weekday_guard",
    o.ctes(o.HOL, o.dates(ORDER_DATES), o.calendar("today"))
    + f"SELECT {iso('as_of')} AS as_of FROM cal WHERE dow_hoy NOT IN (1, 7)",
)
def _weekday_guard(spark, sf_dir):
    cal = business_calendar(order_dates(spark, sf_dir), holidays(spark))
    return weekday_guard(cal).select("as_of")


@query(
    "cutoff_text_compare",
    f"""WITH e AS (SELECT event_id, {o.label("ts")} AS corte, '240115.1300' AS base FROM events)
SELECT event_id, corte FROM e WHERE corte > base""",
)
def _cutoff_text(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", cutoff_label(c("ts")).alias("corte"), F.lit("240115.1300").alias("base")
    )
    return cutoff_filter(e, "corte", "base", ">").drop("base")


@query(
    "backfill_months",
    o.ctes(
        o.HOL,
        o.dates(ORDER_DATES),
        o.calendar("anchor"),
        o.gate(0, True),
        """t AS (SELECT a.as_of, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
FROM orders JOIN abiertos a ON strftime(o_orderdate, '%Y%m') = a.mes GROUP BY a.as_of)""",
    )
    + f"""SELECT {iso("d.as_of")} AS as_of, coalesce(t.n, 0) AS n,
  CAST(coalesce(t.v, 0) AS DOUBLE) AS v FROM dates d LEFT JOIN t ON t.as_of = d.as_of""",
)
def _backfill(spark, sf_dir):
    cal = report_calendar(spark, order_dates(spark, sf_dir), holidays(spark), "anchor")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderdate", c("o_totalprice").cast("decimal(18,2)").alias("v")
    )
    gated = month_gate(orders, cal, "o_orderdate", guard=True)
    return totals_per_date(
        gated, cal.frame, {"n": F.count("*"), "v": weighted_sum(c("v"))}, {}
    ).select("as_of", c("n").cast("bigint").alias("n"), "v")


@query(
    "type_filters",
    """SELECT p_partkey, p_name, p_size FROM part
WHERE p_size IN (1, 2, 6, 7) AND (p_name LIKE 'red%' OR p_name LIKE 's%') AND p_brand IS NOT NULL
  AND coalesce(p_retailprice, 0) > 0""",
)
def _type_filters(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.filter(
        type_filter(c("p_size"), PROFILES["v1"].transfer_types)
        & (c("p_name").startswith("red") | c("p_name").startswith("s"))
        & c("p_brand").isNotNull()
        & labels.positive(c("p_retailprice"))
    ).select("p_partkey", "p_name", "p_size")


@query("type_filter_single", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber = 1")
def _type_filter_single(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return items.filter(
        type_filter(c("l_linenumber"), PROFILES["v1"].disbursement_types)
    ).select("l_orderkey", "l_linenumber")


# -- joins --------------------------------------------------------------------------------


@query(
    "star_detail",
    """SELECT DISTINCT o.o_orderkey, strftime(o.o_orderdate, '%d/%m/%Y') AS fecha, c.c_name, n.n_name,
  p.p_name, s.s_name, CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS valor
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey""",
)
def _star(spark, sf_dir):
    def t(name, *cols):
        return table(spark, sf_dir, name).select(*cols)

    df = t("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    df = lookup(df, t("part", "p_partkey", "p_name"), "l_partkey", "p_partkey")
    df = lookup(df, t("supplier", "s_suppkey", "s_name"), "l_suppkey", "s_suppkey", "left")
    orders = t("orders", "o_orderkey", "o_orderdate", "o_custkey")
    customer = lookup(
        t("customer", "c_custkey", "c_name", "c_nationkey"),
        t("nation", "n_nationkey", "n_name"), "c_nationkey", "n_nationkey", "left",
    )
    orders = lookup(orders, customer, "o_custkey", "c_custkey")
    df = df.join(orders, c("l_orderkey") == c("o_orderkey"))
    out = df.select(
        "o_orderkey",
        ddmmyyyy(c("o_orderdate")).alias("fecha"),
        "c_name",
        "n_name",
        "p_name",
        "s_name",
        c("l_extendedprice").cast("decimal(18,2)").alias("valor"),
    )
    return order_by_ordinal(distinct_rows(out), 3)


@query(
    "bridge_lookup",
    """SELECT c_custkey, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey""",
)
def _bridge(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").drop("n_name")
    return bridge_lookup(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        nation, table(spark, sf_dir, "region"), "c_nationkey", "n_nationkey", "n_regionkey",
        "r_regionkey",
    ).select("c_custkey", "r_name")


@query(
    "bridge_lookup_left",
    """SELECT p_partkey, s_suppkey, r_name FROM part LEFT JOIN supplier ON s_suppkey = p_size
LEFT JOIN nation ON n_nationkey = s_nationkey + 3 LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def _bridge_left(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", (c("s_nationkey") + 3).alias("ref"), c("s_suppkey").alias("id")
    )
    nation = bridge_lookup(
        supplier, table(spark, sf_dir, "nation").drop("n_name"),
        table(spark, sf_dir, "region"), "ref", "n_nationkey", "n_regionkey", "r_regionkey", "left",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", c("p_size").cast("bigint"))
    return lookup(part, nation, "p_size", "id", "left").select("p_partkey", "s_suppkey", "r_name")


@query(
    "lookup_left_inner",
    """SELECT 'documentos' AS hecho, d.source AS grupo, count(*) AS n, count(l.quality) AS unidos
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source
UNION ALL
SELECT 'eventos', c.c_mktsegment, count(*), count(c.c_name)
FROM events e JOIN customer c ON c.c_custkey = e.user_id GROUP BY c.c_mktsegment""",
)
def _left_inner(spark, sf_dir):
    def counts(df, fact, group, matched):
        return df.groupBy(F.lit(fact).alias("hecho"), c(group).alias("grupo")).agg(
            F.count("*").alias("n"), F.count(matched).alias("unidos")
        )

    docs = lookup(
        table(spark, sf_dir, "documents").select("doc_id", "source"),
        table(spark, sf_dir, "labels").select(c("doc_id").alias("lab_id"), "quality"),
        "doc_id", "lab_id", "left",
    )
    events = lookup(
        table(spark, sf_dir, "events").select("user_id"),
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        "user_id", "c_custkey",
    )
    return counts(docs, "documentos", "source", "quality").unionAll(
        counts(events, "eventos", "c_mktsegment", "c_name")
    )


# -- ranked children ----------------------------------------------------------------------


def _children(spark, sf_dir):
    pm = relations(spark, sf_dir)["informacionpm"]
    return ranked_children(
        pm, ["DatosFactura"], ["idInformacionPM"],
        ["idInformacionPM", "Operacionacancelar", "valorcruce"],
    )


@query(
    "ranked_children",
    o.ctes(o.rel("informacionpm"), o.folded())
    + """SELECT o_orderkey, coalesce(max(h.rk), 0) AS hijos,
  max(CASE WHEN rk = 1 THEN op END) AS primero, max(CASE WHEN rk = 10 THEN op END) AS decimo
FROM orders LEFT JOIN (SELECT * FROM hijos WHERE rk <= 10) h ON h.k = o_orderkey
GROUP BY o_orderkey""",
)
def _ranked(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    df = lookup(orders, _children(spark, sf_dir), "o_orderkey", "DatosFactura", "left")
    kids = c("children")
    return df.select(
        "o_orderkey",
        text.nvl(F.size(kids), 0).cast("bigint").alias("hijos"),
        F.get(kids, F.lit(0))["Operacionacancelar"].alias("primero"),
        F.get(kids, F.lit(9))["Operacionacancelar"].alias("decimo"),
    )


def _ranked_fold(style):
    def fn(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").select("o_orderkey")
        kids = ranked_fold(
            relations(spark, sf_dir)["informacionpm"], ["DatosFactura"], ["idInformacionPM"],
            "Operacionacancelar", "valorcruce", style, out="cuenta",
        )
        return lookup(orders, kids, "o_orderkey", "DatosFactura", "left")

    return fn


def _array_fold(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    kids = _children(spark, sf_dir).select(
        "DatosFactura",
        fold_ranked(c("children"), "Operacionacancelar", "valorcruce").alias("cuenta"),
    )
    return lookup(orders, kids, "o_orderkey", "DatosFactura", "left")


query(
    "ranked_fold_of_arrays",
    o.ctes(o.rel("informacionpm"), o.folded("plain"))
    + "SELECT o_orderkey, ranked AS cuenta FROM orders LEFT JOIN plegado ON k = o_orderkey",
)(_array_fold)
for _name, _style in (("ranked_fold", "plain"), ("ranked_fold_draft", "grouped")):
    query(
        _name,
        o.ctes(o.rel("informacionpm"), o.folded(_style))
        + "SELECT o_orderkey, ranked AS cuenta FROM orders LEFT JOIN plegado ON k = o_orderkey",
    )(_ranked_fold(_style))


def _ops(n, col):
    return f"concat({col}, ' - $', {o.money(f'abs(valorcruce{n})')})"


@query(
    "fixed_fold",
    o.ctes(o.rel("operaciones"))
    + f"""SELECT idOperaciones, CASE
  WHEN OperacionaCancelarPM2 IS NULL THEN {_ops(1, "OperacionCancelarPM")}
  WHEN OperacionaCancelarPM3 IS NULL
    THEN concat_ws(' // ', {_ops(1, "OperacionCancelarPM")}, {_ops(2, "OperacionaCancelarPM2")})
  ELSE concat_ws(' // ', {_ops(1, "OperacionCancelarPM")}, {_ops(2, "OperacionaCancelarPM2")},
    {_ops(3, "OperacionaCancelarPM3")}) END AS cuenta FROM operaciones""",
)
def _fixed_fold(spark, sf_dir):
    ope = relations(spark, sf_dir)["operaciones"]
    ops = [c("OperacionCancelarPM"), c("OperacionaCancelarPM2"), c("OperacionaCancelarPM3")]
    values = [c("valorcruce1"), c("valorcruce2"), c("valorcruce3")]
    return ope.select("idOperaciones", fold_fixed(ops, values).alias("cuenta"))


# -- text ---------------------------------------------------------------------------------


@query(
    "money_text",
    f"""WITH x AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL
  ELSE CAST(c_acctbal AS DECIMAL(18,2)) * 1.005 END AS v FROM customer)
SELECT c_custkey, {o.money("v")} AS txt,
  lpad('<' || {o.money("v")} || '>', 30, ' ') AS ancho,
  replace(replace(replace(format('{{:,.2f}}', round(coalesce(v, 0), 2)::DECIMAL(18,2)::DOUBLE),
    ',', '_'), '.', ','), '_', '.') AS miles,
  {o.grouped("v")} AS grupos FROM x""",
)
def _money(spark, sf_dir):
    v = F.when(c("c_custkey") % 9 == 0, None).otherwise(
        c("c_acctbal").cast("decimal(18,2)") * F.lit("1.005").cast("decimal(4,3)")
    )
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", v.alias("v"))
        .select(
            "c_custkey",
            text.money_text(c("v")).alias("txt"),
            text.money_text(c("v"), width=30, prefix="<", suffix=">").alias("ancho"),
            text.money_text(c("v"), dec=",", grp=".").alias("miles"),
            text.grouped_text(c("v")).alias("grupos"),
        )
    )


@query(
    "num_text",
    f"""SELECT l_orderkey, l_linenumber, {o.num("CAST(l_extendedprice AS DECIMAL(18,2))")} AS precio,
  {o.num("-CAST(l_discount AS DECIMAL(18,2))")} AS descuento,
  concat('$', {o.num("nullif(CAST(l_tax AS DECIMAL(18,6)), 0)")}) AS impuesto
FROM lineitem""",
)
def _num(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    tax = c("l_tax").cast("decimal(18,6)")
    return items.select(
        "l_orderkey",
        "l_linenumber",
        text.num_text(c("l_extendedprice").cast("decimal(18,2)")).alias("precio"),
        text.num_text(-c("l_discount").cast("decimal(18,2)")).alias("descuento"),
        text.dollar(text.num_text(F.nullif(tax, F.lit(0)))).alias("impuesto"),
    )


@query(
    "zero_pad",
    f"""WITH pl AS (SELECT * FROM ({duck(SQL["planfinanciacion"])}) q)
SELECT idPlanFinanciacion, {o.pad3("Cuotas")} AS cuotas, {o._unit()} || {o.pad3("Cuotas")} AS plazo,
  concat({o._unit()}, {o.months3("Cuotas")}) AS plazo_borrador,
  lpad(CAST(CAST(Cuotas * 0.125 AS DECIMAL(18,2)) AS VARCHAR), 9, '0') AS ancho FROM pl""",
)
def _zero_pad(spark, sf_dir):
    pl = relations(spark, sf_dir)["planfinanciacion"]
    eighth = (c("Cuotas") * F.lit("0.125").cast("decimal(4,3)")).cast("decimal(18,2)")
    return pl.select(
        "idPlanFinanciacion",
        text.zero_pad(c("Cuotas"), 3).alias("cuotas"),
        text.term_code(c("unidadTiempo"), c("Cuotas")).alias("plazo"),
        text.term_code(c("unidadTiempo"), c("Cuotas"), "grouped").alias("plazo_borrador"),
        F.when(c("Cuotas").isNotNull(), text.fixed_number_text(eighth, 9, 2)).alias("ancho"),
    )


@query(
    "sql_functions",
    f"""SELECT c_custkey, lpad({o.money("CAST(c_acctbal AS DECIMAL(18,2))")}, 30, ' ') AS txt,
  lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS cuotas,
  lpad(concat(CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END,
    lpad(CAST(abs(CAST(c_acctbal AS DECIMAL(18,2))) AS VARCHAR), 11, '0')), 11, '0') AS saldo
FROM customer""",
)
def _sql_functions(spark, sf_dir):
    create_sql_functions(spark)
    return spark.sql(
        "SELECT c_custkey, formatmoney(CAST(c_acctbal AS DECIMAL(18,2)), 30, '', '', ',', '') AS txt,"
        " format_number_padded(c_nationkey, '', 3) AS cuotas,"
        " format_number_padded(CAST(c_acctbal AS DECIMAL(18,2)), '', 11, 2) AS saldo"
        " FROM {customer}",
        customer=table(spark, sf_dir, "customer"),
    )


@query(
    "display_name",
    o.ctes(o.rel("originacion", "originacion_solicitudes", "cliente"))
    + """SELECT og.caso, CASE WHEN s.Nombres IS NOT NULL THEN s.Nombres
  WHEN cl.NombreConcatenado IS NOT NULL
    THEN replace(substr(cl.NombreConcatenado, 1, 100), 'Cliente : ', '')
  ELSE upper(concat(cl.Apellido1, ' ', cl.Apellido2, ', ', cl.Nombre1, ' ', cl.Nombre2))
  END AS nombre
FROM originacion og LEFT JOIN originacion_solicitudes s ON s.solicitud = og.caso
LEFT JOIN cliente cl ON cl.idCliente = og.Cliente""",
)
def _display_name(spark, sf_dir):
    t = relations(spark, sf_dir)
    df = t["originacion"].select("caso", "Cliente")
    sor = t["originacion_solicitudes"].select("solicitud", "Nombres")
    df = lookup(df, sor, "caso", "solicitud", "left")
    df = lookup(df, t["cliente"], "Cliente", "idCliente", "left")
    name = labels.display_name(
        c("Nombres"), c("NombreConcatenado"), c("Apellido1"), c("Apellido2"), c("Nombre1"),
        c("Nombre2"),
    )
    return df.select("caso", name.alias("nombre"))


@query(
    "empty_text_inputs",
    o.ctes(
        o.rel("originacion", "originacion_solicitudes", "datosfactura", "informacionpm"),
        o.folded(),
    )
    + """SELECT og.caso, s.Nombres AS nombre, coalesce(f.MarcaFactura, s.Marca) AS marca,
  s.fasecolda, pm.ranked AS cuenta, pm.op1 AS primera
FROM originacion og LEFT JOIN originacion_solicitudes s ON s.solicitud = og.caso
LEFT JOIN datosfactura f ON f.idDatosFactura = og.DatosFactura
LEFT JOIN plegado pm ON pm.k = f.idDatosFactura""",
)
def _empty_text_inputs(spark, sf_dir):
    t = relations(spark, sf_dir)
    sor = t["originacion_solicitudes"].select("solicitud", "Nombres", "Marca", "fasecolda")
    df = lookup(t["originacion"].select("caso", "DatosFactura"), sor, "caso", "solicitud", "left")
    invoice = t["datosfactura"].select("idDatosFactura", "MarcaFactura")
    df = lookup(df, invoice, "DatosFactura", "idDatosFactura", "left")
    children = ranked_children(
        t["informacionpm"], ["DatosFactura"], ["idInformacionPM"],
        ["Operacionacancelar", "valorcruce"],
    ).withColumnRenamed("DatosFactura", "pm_factura")
    df = df.join(children, c("DatosFactura") == c("pm_factura"), "left")
    first = F.get("children", F.lit(0))
    return df.select(
        "caso",
        c("Nombres").alias("nombre"),
        F.coalesce("MarcaFactura", "Marca").alias("marca"),
        "fasecolda",
        F.when(
            first.isNotNull(), fold_ranked(c("children"), "Operacionacancelar", "valorcruce")
        ).alias("cuenta"),
        first["Operacionacancelar"].alias("primera"),
    )


@query(
    "remarks_channel",
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS monto,
  CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(18,2)) END AS subsidio,
  CASE WHEN l_linestatus = 'F' THEN CAST(l_tax AS DECIMAL(18,2)) END AS bono,
  CASE WHEN l_discount > 0.05 THEN CAST(l_discount AS DECIMAL(18,2)) END AS acc,
  l_linenumber = 6 AND l_suppkey % 2 = 1 AS prep,
  CASE l_returnflag WHEN 'A' THEN '81' WHEN 'N' THEN '98' ELSE '70' END || l_partkey AS oper,
  l_linenumber % 2 AS plan FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN prep THEN 'MANTENIMIENTO PREPAGADO'
    WHEN subsidio > 0 AND bono > 0 AND acc > 0 THEN 'CON ACCESORIOS SUBVENCIONADO-' || texto
    WHEN subsidio > 0 AND bono > 0 THEN 'SUBVENCIONADO-' || texto
    WHEN subsidio > 0 THEN 'SUBVENCIONADO' WHEN bono > 0 THEN texto
    WHEN acc > 0 THEN 'ACCESORIOS' ELSE '' END AS observaciones,
  CASE WHEN plan = 1 AND oper LIKE '81%' THEN 'PAGO ALTAIR'
    WHEN plan = 1 AND oper LIKE '98%' THEN 'PAGO BOT' ELSE 'GIRO ACH' END AS canal_v1,
  CASE WHEN prep THEN 'GIRO ACH' WHEN plan = 1 AND oper LIKE '81%' THEN 'PAGO ALTAIR'
    WHEN plan = 1 AND oper LIKE '98%' THEN 'PAGO BOT' ELSE 'GIRO ACH' END AS canal_v2,
  '$' || replace(CAST(CASE WHEN prep THEN monto ELSE monto + coalesce(acc, 0) END AS VARCHAR), '.', ',')
    AS girar,
  CASE WHEN bono > 0 THEN 'Anual' WHEN acc > 0 THEN 'Mensual' ELSE '' END AS modalidad,
  CAST(coalesce(bono, acc, 0) AS DOUBLE) AS proteccion,
  CAST(CASE WHEN l_linenumber = 2 THEN 0 ELSE coalesce(acc, 0) END AS DOUBLE) AS rgm,
  CASE WHEN plan = 1 THEN '' ELSE oper END AS tipo
FROM (SELECT *, 'DESCUENTO BONO POLIZA $' || """
    + o.num("bono")
    + " AS texto FROM x) y",
)
def _remarks(spark, sf_dir):
    def d(name):
        return c(name).cast("decimal(18,2)")

    x = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        d("l_extendedprice").alias("monto"),
        F.when(c("l_returnflag") == "A", d("l_quantity")).alias("subsidio"),
        F.when(c("l_linestatus") == "F", d("l_tax")).alias("bono"),
        F.when(c("l_discount") > 0.05, d("l_discount")).alias("acc"),
        labels.is_prepaid(c("l_suppkey") % 2, c("l_linenumber")).alias("prep"),
        F.concat(
            F.when(c("l_returnflag") == "A", "81").when(c("l_returnflag") == "N", "98")
            .otherwise("70"),
            c("l_partkey").cast("string"),
        ).alias("oper"),
        (c("l_linenumber") % 2).alias("plan"),
    )
    return x.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        labels.remarks(c("prep"), c("subsidio"), c("bono"), c("acc")).alias("observaciones"),
        labels.channel(c("plan"), c("oper"), c("prep"), False).alias("canal_v1"),
        labels.channel(c("plan"), c("oper"), c("prep"), True).alias("canal_v2"),
        labels.transfer_value(c("monto"), c("acc"), c("prep"), "plain").alias("girar"),
        labels.protection_mode(c("bono"), c("acc")).alias("modalidad"),
        labels.protection_value(c("bono"), c("acc")).alias("proteccion"),
        labels.guarantee_fee(c("l_linenumber"), c("acc")).alias("rgm"),
        labels.account_type(c("plan"), c("oper")).alias("tipo"),
    )


# -- masks --------------------------------------------------------------------------------


@query(
    "number_masks",
    """WITH x AS (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS v,
  CAST(round(CAST(c_acctbal AS DECIMAL(18,2)), 0) AS BIGINT) AS n FROM customer)
SELECT c_custkey, format('{:,.2f}', CAST(v AS DOUBLE)) AS agrupado,
  CASE WHEN abs(n) >= 1000 THEN '####'
    ELSE lpad(CASE WHEN n < 0 THEN '-' ELSE '' END || CAST(abs(n) AS VARCHAR), 4, ' ') END AS tres,
  lpad(CASE WHEN n < 0 THEN '-' ELSE '' END || lpad(CAST(abs(n) AS VARCHAR), 6, '0'), 7, ' ') AS ceros,
  lpad(CASE WHEN v < 0 THEN '-' ELSE '' END || '$' || replace(replace(replace(
    format('{:,.2f}', CAST(abs(v) AS DOUBLE)), ',', ';'), '.', ','), ';', '.'), 14, ' ') AS pesos
FROM x""",
)
def _number_masks(spark, sf_dir):
    v = c("c_acctbal").cast("decimal(18,2)")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        number_text(v, "FM999G999G990D00").alias("agrupado"),
        number_text(v, "999").alias("tres"),
        number_text(v, "000000").alias("ceros"),
        number_text(v, "$9G999G990D00", ",", ".").alias("pesos"),
    )


_MONTHS_SQL = "['" + "','".join(m.capitalize() for m in MONTH_NAMES) + "']"


@query(
    "date_masks",
    f"""SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y %H:%M') AS momento,
  strftime(o_orderdate, '%y%m%d') AS corto, CAST(dayofweek(o_orderdate) + 1 AS VARCHAR) AS dia,
  {_MONTHS_SQL}[month(o_orderdate)] || ' de ' || CAST(year(o_orderdate) AS VARCHAR) AS mes,
  rpad(upper({_MONTHS_SQL}[month(o_orderdate)]), 10, ' ') AS mes_largo FROM orders""",
)
def _date_masks(spark, sf_dir):
    d = c("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        date_text(d, "DD/MM/YYYY HH24:MI").alias("momento"),
        date_text(d, "YYMMDD").alias("corto"),
        date_text(d, "D").alias("dia"),
        date_text(d, 'FMMonth" de "YYYY').alias("mes"),
        date_text(d, "MONTH").alias("mes_largo"),
    )


# -- totals -------------------------------------------------------------------------------

_TOTAL_LAYOUT = [None, None, "cantidad", "precio", None, "neto"]


def _totals(where):
    def fn(spark, sf_dir):
        items = table(spark, sf_dir, "lineitem")
        if where is not None:
            items = items.filter(where)
        facts = items.select(
            F.lit(EVENTS_AS_OF).alias("as_of"),
            c("l_quantity").cast("decimal(18,2)").alias("q"),
            (-c("l_extendedprice").cast("decimal(18,2)")).alias("p"),
        )
        day = table(spark, sf_dir, "region").select(F.lit(EVENTS_AS_OF).alias("as_of")).distinct()
        sums = totals_per_date(
            facts,
            day,
            {"q": weighted_sum(c("q")), "p": weighted_sum(F.abs(c("p")))},
            {"t": weighted_sum(c("p"), guard=False)},
        )
        out = sums.select(
            "as_of",
            text.dollar(text.num_text(c("q"))).alias("cantidad"),
            text.money_text(c("p")).alias("precio"),
            text.dollar(text.num_text(c("t"))).alias("neto"),
        )
        return positional(out, _TOTAL_LAYOUT, "TOTAL", "").drop("as_of")

    return fn


def _totals_sql(where):
    return f"""WITH t AS (SELECT sum(CAST(l_quantity AS DECIMAL(18,2))) AS q,
  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS p FROM lineitem {where})
SELECT 'TOTAL' AS c01, '' AS c02, concat('$', {o.num("coalesce(q, 0)")}) AS cantidad,
  {o.money("p")} AS precio, '' AS c05, concat('$', {o.num("-p")}) AS neto FROM t"""


query("totals_guarded", _totals_sql(""))(_totals(None))
# No line has a negative quantity: the totals row of an empty input.
query("totals_empty", _totals_sql("WHERE l_quantity < 0"))(_totals("l_quantity < 0"))


# -- reports ------------------------------------------------------------------------------

_MONTH_DAYS = [EVENTS_AS_OF, dt.date(2024, 2, 18)]


def _month_report(fn, profile):
    """Two reporting dates whose gates reach one month each."""

    def q(spark, sf_dir):
        t = relations(spark, sf_dir, profile)
        cal = report_calendar(spark, _MONTH_DAYS, holidays(spark))
        return fn(t, cal, profile)

    return q


for _fn, _sql, _profile in (
    (disbursement_detail, o.disbursement_detail, "v2"),
    (transfer_detail, o.transfer_detail, "v1"),
    (transfer_detail, o.transfer_detail, "v2"),
    (disbursement_totals, o.disbursement_totals, "v1"),
):
    query(
        f"month_{_fn.__name__}_{_profile}",
        _sql(_profile, " UNION ".join(map(_one_date, _MONTH_DAYS))),
    )(_month_report(_fn, _profile))


def _scratch(spark: SparkSession) -> str:
    """A new place in the folder that all executors share; a local one only on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='mesada-')}/{uuid.uuid4().hex}"


def _flat_file(fn, profile, as_of):
    """A report written as one flat file and read back by position."""

    def q(spark, sf_dir):
        cal = report_calendar(spark, as_of, holidays(spark))
        df = fn(relations(spark, sf_dir, profile), cal, profile)
        path = f"{_scratch(spark)}/{fn.__name__}.csv"
        write_report_file(df, path, header=True)
        return read_report_file(spark, path, df.schema, header=True)

    return q


for _fn, _sql, _profile in (
    (transfer_detail, o.transfer_detail, "v2"),
    (disbursement_totals, o.disbursement_totals, "v1"),
):
    query(
        f"flat_file_{_fn.__name__}_{_profile}",
        _sql(_profile, " UNION ".join(map(_one_date, _MONTH_DAYS))),
    )(_flat_file(_fn, _profile, _MONTH_DAYS))


@query(
    "facts_of_requests",
    o.ctes(o.rel("desembolsorelacion"))
    + """SELECT solicitud, count(*) AS n, CAST(sum(montoDesembolsar) AS DOUBLE) AS monto
FROM desembolsorelacion WHERE solicitud IN (SELECT o_orderkey FROM orders
  WHERE o_totalprice > (SELECT 0.9 * max(o_totalprice) FROM orders)) GROUP BY solicitud""",
)
def _facts_of_requests(spark, sf_dir):
    """Sendings stored by month and request, of which only some requests are read."""
    path = f"{_scratch(spark)}/envios"
    write_by_month(
        relations(spark, sf_dir)["desembolsorelacion"], path, "fechaenvio", sort_col="solicitud"
    )
    orders = table(spark, sf_dir, "orders")
    high = orders.agg((F.lit(0.9) * F.max("o_totalprice")).alias("alto"))
    keys = orders.join(high, c("o_totalprice") > c("alto")).select("o_orderkey")
    rows = only_keys(spark.read.parquet(path), "solicitud", keys)
    return rows.groupBy("solicitud").agg(
        F.count("*").alias("n"), F.sum("montoDesembolsar").alias("monto")
    )


def _pushed(fn, profile):
    """The same from relations cut to the months, requests and keys of the report."""

    def q(spark, sf_dir):
        cal = report_calendar(spark, _MONTH_DAYS, holidays(spark))
        return fn(pushed_relations(spark, derived(sf_dir), cal, profile), cal, profile)

    return q


for _fn, _sql, _profile in (
    (disbursement_detail, o.disbursement_detail, "v2"),
    (transfer_detail, o.transfer_detail, "v2"),
    (disbursement_totals, o.disbursement_totals, "v1"),
):
    query(
        f"pushed_{_fn.__name__}_{_profile}",
        _sql(_profile, " UNION ".join(map(_one_date, _MONTH_DAYS))),
    )(_pushed(_fn, _profile))


def _report(fn, profile):
    def q(spark, sf_dir):
        p = get_profile(profile)
        cal = backfill_calendar(spark, sf_dir, p.holiday_rule)
        return fn(relations(spark, sf_dir, p), cal, p)

    return q


# The rules of the older origin: '' stays, and a NULL part makes a whole text NULL.
_OLDER = replace(get_profile("v2"), empty_as_null=False, null_concat=True)
query("older_disbursement_detail", o.disbursement_detail("v2", older=True))(
    _report(disbursement_detail, _OLDER)
)
query("older_disbursement_totals", o.disbursement_totals("v2", older=True))(
    _report(disbursement_totals, _OLDER)
)


for _profile in ("v1", "v2", "draft"):
    query(f"disbursement_detail_{_profile}", o.disbursement_detail(_profile))(
        _report(disbursement_detail, _profile)
    )
    query(f"transfer_detail_{_profile}", o.transfer_detail(_profile))(
        _report(transfer_detail, _profile)
    )
for _profile in ("v1", "v2"):
    query(f"disbursement_totals_{_profile}", o.disbursement_totals(_profile))(
        _report(disbursement_totals, _profile)
    )
    query(f"transfer_totals_{_profile}", o.transfer_totals(_profile))(
        _report(transfer_totals, _profile)
    )


def _from_parts(report, profile):
    """All months' partial sums stored, then the totals of every date from them."""

    def q(spark, sf_dir):
        path = f"{_scratch(spark)}/{report}"
        write_partial_totals(relations(spark, sf_dir, profile), path, report, profile)
        cal = backfill_calendar(spark, sf_dir, get_profile(profile).holiday_rule)
        return totals_from_parts(spark, path, cal, report, profile)

    return q


for _kind, _sql, _profile in (
    (DISBURSEMENT, o.disbursement_totals, "v1"),
    (DISBURSEMENT, o.disbursement_totals, "v2"),
    (TRANSFER, o.transfer_totals, "v1"),
    (TRANSFER, o.transfer_totals, "v2"),
):
    query(f"parts_{_kind}_totals_{_profile}", _sql(_profile))(_from_parts(_kind, _profile))
