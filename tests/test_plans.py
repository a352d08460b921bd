"""Plan shapes: what reaches the scans, how often data is shuffled, and skew handling."""

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from report_fixture import relations, rows

from mesada import (
    disbursement_detail,
    disbursement_totals,
    report_calendar,
    transfer_detail,
    transfer_totals,
)
from mesada.operators.distinct import distinct_rows
from mesada.operators.gate import month_gate
from mesada.operators.ordering import order_by_ordinal
from mesada.operators.ranked import ranked_children
from mesada.sources.readers import conform
from mesada.sources.writers import MONTH_COLUMN, write_by_key, write_by_month

AS_OF = dt.date(2024, 2, 1)


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Sendings of two years as files, plain and by month."""
    base = tmp_path_factory.mktemp("envios")
    df = spark.sql("""
      select id as solicitud, cast('2023-01-01' as timestamp_ntz) + id * interval '1' hour
        as fechaenvio, id * 2 as unused from range(24 * 700)""")
    df.write.parquet(str(base / "plain"))
    write_by_month(df, str(base / "months"), "fechaenvio")
    return base


def test_gate_range_reaches_the_scan(spark, holidays, stored):
    cal = report_calendar(spark, [AS_OF], holidays)
    df = spark.read.parquet(str(stored / "plain"))
    text = plan(month_gate(df, cal, "fechaenvio", cutoff_op=">").select("solicitud", "corte"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(fechaenvio,2024-01-01T00:00)" in pushed
    assert "LessThan(fechaenvio,2024-02-01T00:00)" in pushed
    assert "unused" not in re.search(r"ReadSchema: (.*)", text).group(1)
    # The first batch needs the first days only.
    text = plan(month_gate(df, cal, "fechaenvio", cutoff_op="="))
    assert "LessThan(fechaenvio,2024-01-05T00:00)" in text
    # One shuffle-free broadcast join with the calendar; facts are not moved.
    assert "BroadcastHashJoin" in text and "BroadcastNestedLoopJoin" not in text


def test_gate_reads_only_its_months(spark, holidays, stored):
    df = spark.read.parquet(str(stored / "months"))
    dates = [AS_OF, dt.date(2024, 2, 2)]
    cal = report_calendar(spark, dates, holidays)
    gated = month_gate(df, cal, "fechaenvio", cutoff_op=">", month_col=MONTH_COLUMN)
    assert "PartitionFilters: [isnotnull(envio_mes" in plan(gated)
    plain = month_gate(
        spark.read.parquet(str(stored / "plain")), cal, "fechaenvio", cutoff_op=">"
    )
    cols = ["as_of", "solicitud", "corte"]
    assert gated.select(cols).exceptAll(plain.select(cols)).count() == 0
    assert gated.count() == plain.count() > 0
    # Without literal dates the months are pruned when the calendar is known.
    late = report_calendar(spark, cal.frame.select("as_of"), holidays)
    text = plan(month_gate(df, late, "fechaenvio", month_col=MONTH_COLUMN))
    assert "dynamicpruning" in text


def test_month_files_hold_one_month(spark, stored):
    months = [p.name for p in (stored / "months").iterdir() if p.name.startswith(MONTH_COLUMN)]
    assert len(months) == 23


def test_ranked_children_need_one_shuffle_and_limit_before_it(spark):
    df = spark.range(0, 1000, 1, 4).selectExpr("id % 5 p", "id o", "cast(id as string) s")
    text = plan(ranked_children(df, ["p"], ["o"], ["s"]), "simple")
    assert text.count("Exchange") == 1
    assert len(re.findall(r"Window \[", text)) == 1
    # Rows are cut to ten per parent in each map task.
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_reports_stay_out_of_python(spark, holidays):
    t = relations(spark, rows(children=[(1, 101, "81A", 5)]))
    cal = report_calendar(spark, [AS_OF], holidays)
    for report in (disbursement_detail, transfer_detail, disbursement_totals, transfer_totals):
        for profile in ("v1", "v2"):
            text = plan(report(t, cal, profile), "simple")
            assert "Python" not in text and "ArrowEval" not in text
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # The children's rank and their text: two windows over one shuffle of them.
    text = plan(transfer_detail(t, cal, "v2"), "simple")
    assert len(re.findall(r" Window \[", text)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(DatosFactura", text)) == 1


BUCKETED = {
    "datosfactura": "idDatosFactura",
    "operaciones": "idOperaciones",
    "seguros": "idSeguros",
    "informacionestudio": "idInformacionestudio",
}


def test_lookups_stored_by_key_are_not_shuffled(spark, holidays, tmp_path):
    t = relations(spark, rows(children=[(1, 101, "81A", 5)]))
    spark.sql(f"CREATE DATABASE por_clave LOCATION '{tmp_path}'")
    for name, key in BUCKETED.items():
        write_by_key(t[name], f"por_clave.{name}", key, 4)
    held = {n: conform(spark.table(f"por_clave.{n}"), n, True) for n in BUCKETED}
    cal = report_calendar(spark, [AS_OF], holidays)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(disbursement_detail({**t, **held}, cal, "v1"), "simple")
        plain = plan(disbursement_detail(t, cal, "v1"), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # The other side of each of these joins is shuffled, the stored table is not.
    assert text.count("Exchange hashpartitioning") == plain.count("Exchange hashpartitioning") - 4
    result = sorted(map(str, disbursement_detail({**t, **held}, cal, "v1").collect()))
    assert result == sorted(map(str, disbursement_detail(t, cal, "v1").collect()))
    spark.sql("DROP DATABASE por_clave CASCADE")


def test_totals_cut_lines_below_the_grouping(spark, holidays):
    t = relations(spark, rows())
    cal = report_calendar(spark, [AS_OF], holidays)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = [plan(f(t, cal, "v1"), "simple") for f in (disbursement_totals, transfer_totals)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for text in texts:
        lines = text.splitlines()
        (semi,) = [k for k, line in enumerate(lines) if "LeftSemi" in line]
        group = max(k for k in range(semi) if "HashAggregate(keys=[Solicitud" in lines[k])
        assert not any("Exchange" in line for line in lines[group:semi])


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_request_is_split(spark, holidays, skewed):
    # One request owns a third of all sendings; each of them differs.
    t = dict(relations(spark, rows()))
    hot = spark.range(0, 6000, 1, 8).selectExpr(
        "if(id % 3 = 0, 101, id + 1000) solicitud",
        "cast('2024-01-02 08:00:00' as timestamp_ntz) fechaenvio",
        "1 IdDesembolsoDetalle",
        "sha2(cast(id as string), 512) razonSocial",
        "sha2(cast(-id as string), 512) numeroIdentificacion",
        "1 idBanco",
        "cast(id as string) numeroCuenta",
        "'AHORROS' tipoCuenta",
        "cast(id as decimal(18,2)) montoDesembolsar",
    )
    t["desembolsorelacion"] = hot.repartition(8)
    cal = report_calendar(spark, [AS_OF], holidays)
    out = transfer_detail(t, cal, "v1", ordered=False)
    assert "skew=true" in final_plan(out)
    assert out.count() == 6000
    assert out.filter("SOLICITUD = 101").count() == 2000


def test_hot_invoice_is_split(spark, holidays, skewed):
    # A third of the requests share one invoice, another third have none.
    n = 6000
    t = dict(relations(spark, rows(plan={101: (1, ("81", None, None, 1, None, None))},
                                   children=[(1, 101, "81A", 5)])))
    ids = spark.range(1000, 1000 + n, 1, 8)
    t["desembolsorelacion"] = ids.selectExpr(
        "id solicitud",
        "cast('2024-01-02 08:00:00' as timestamp_ntz) fechaenvio",
        "1 IdDesembolsoDetalle",
        "'R' razonSocial",
        "'N' numeroIdentificacion",
        "1 idBanco",
        "'C' numeroCuenta",
        "'AHORROS' tipoCuenta",
        "cast(id as decimal(18,2)) montoDesembolsar",
    ).repartition(8)
    t["originacion"] = ids.selectExpr(
        "id caso",
        "case id % 3 when 0 then 101 when 1 then id end DatosFactura",
        "id Seguros",
        "id InformaciondeEstudio",
        "101 + 0 * id Operaciones",
        "id PlanFinanciacion",
        "id Cliente",
        "id Vehiculo",
    ).repartition(8)
    cal = report_calendar(spark, [AS_OF], holidays)
    out = transfer_detail(t, cal, "v1", ordered=False)
    text = final_plan(out)
    assert re.search(r"SortMergeJoin\(skew=true\) \[ori_DatosFactura", text)
    counts = {r[0]: r[1] for r in out.groupBy("NUMEROCUENTA").count().collect()}
    assert counts == {"81A - $5,00  ": n // 3, "81 - $1,00": n - n // 3}


def test_hot_line_request_is_split(spark, holidays, skewed):
    # The same for the lines of a disbursement.
    t = dict(relations(spark, rows()))
    t["desembolso"] = (
        spark.range(0, 6000, 1, 8)
        .selectExpr(
            "if(id % 3 = 0, 101, id + 1000) Solicitud",
            "sha2(cast(id as string), 512) numeroCredito",
            "'CC' tipoIdentificacion",
            "sha2(cast(-id as string), 512) numeroIdentificacion",
            "cast(id as decimal(18,2)) montoDesembolsar",
            "1 IdDesembolsodetalle",
        )
        .repartition(8)
    )
    cal = report_calendar(spark, [AS_OF], holidays)
    out = disbursement_detail(t, cal, "v1", ordered=False)
    assert "skew=true" in final_plan(out)
    assert out.count() == 2000
    (total,) = disbursement_totals(
        t, report_calendar(spark, [dt.date(2024, 2, 18)], holidays), "v1"
    ).collect()
    assert total["TOTALDESEMBOLSO"] == f"${sum(range(0, 6000, 3))}"


def test_distinct_is_not_tied_to_a_join_key(spark):
    a = spark.range(100).selectExpr("id % 7 k", "id % 3 v").repartition(4, "k")
    text = plan(distinct_rows(a.select("k", "v")), "simple")
    assert text.count("Exchange") == 2
    assert sorted(map(tuple, distinct_rows(a).collect())) == sorted(
        {(i % 7, i % 3) for i in range(100)}
    )


def test_order_with_one_sort_value_uses_many_tasks(spark):
    df = spark.range(0, 20000, 1, 4).selectExpr("id", "'240102.0900' as `CORTE DISPERSION`")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = order_by_ordinal(df, 2)
        sizes = Counter(r[0] for r in out.select(F.spark_partition_id()).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(sizes) >= 2 and max(sizes.values()) < 15000


def test_totals_read_the_sendings_once(spark, holidays, tmp_path):
    t = dict(relations(spark, rows()))
    t["desembolsorelacion"].write.parquet(str(tmp_path / "envios"))
    t["desembolsorelacion"] = spark.read.parquet(str(tmp_path / "envios"))
    cal = report_calendar(spark, [AS_OF], holidays)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = [spark.conf.get(k) for k in keys]
    for key, value in zip(keys, ("-1", "false"), strict=True):
        spark.conf.set(key, value)
    try:
        for report in (disbursement_totals, transfer_totals):
            for profile in ("v1", "v2"):
                text = plan(report(t, cal, profile), "simple")
                assert text.count("FileScan parquet") == 1 and "ReusedExchange" in text
    finally:
        for key, value in zip(keys, old, strict=True):
            spark.conf.set(key, value)
