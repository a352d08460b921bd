"""

usage: bench_shapes.py [sf_dir]
"""

from __future__ import annotations

import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from analogue.relations import holidays, relations, run, table
from mesada.functions.text import money, nvl
from mesada.operators.calendar import report_calendar
from mesada.operators.gate import month_gate
from mesada.operators.ranked import MAX_CHILDREN, fold_ranked, ranked_children, with_rank
from mesada.operators.totals import totals_per_date, weighted_sum
from mesada.session import local_session

c = F.col
COLS = ["idInformacionPM", "Operacionacancelar", "valorcruce"]


def median(fn, runs=3):
    fn()
    samples = []
    for _ in range(runs):
        start = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - start)
    return round(statistics.median(samples), 2)


def sink(df):
    df.write.format("noop").mode("overwrite").save()


def one_array(orders, pm):
    kids = ranked_children(pm, ["DatosFactura"], ["idInformacionPM"], COLS)
    return orders.join(kids, c("o_orderkey") == c("DatosFactura"), "left").select(
        "o_orderkey", fold_ranked(c("children"), "Operacionacancelar", "valorcruce").alias("t")
    )


def ten_joins(orders, pm):
    """One ranked sub-select and one left join per child."""
    df, parts = orders, []
    for k in range(1, MAX_CHILDREN + 1):
        ranked = with_rank(pm, ["DatosFactura"], ["idInformacionPM"]).filter(c("conteo") == k)
        side = ranked.select(
            c("DatosFactura").alias(f"k{k}"), c("Operacionacancelar").alias(f"op{k}"),
            c("valorcruce").alias(f"v{k}"),
        )
        df = df.join(side, c("o_orderkey") == c(f"k{k}"), "left")
        parts += [c(f"op{k}"), money(F.abs(nvl(c(f"v{k}"), 0)), "plain")]
    return df.select("o_orderkey", F.concat_ws("", *parts).alias("t"))


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = local_session(8, "mesada-shapes")
    spark.sparkContext.setLogLevel("ERROR")

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    # The given file is one row group, which one task reads; a fact table has many.
    relations(spark, sf_dir)["informacionpm"].repartition(16).write.parquet(f"{scratch}/pm")
    pm = spark.read.parquet(f"{scratch}/pm")
    print("ten joins", median(lambda: sink(ten_joins(orders, pm))), flush=True)
    print("one array", median(lambda: sink(one_array(orders, pm))), flush=True)

    # Sorted by time and in several row groups, as a fact table would be.
    path = f"{scratch}/orders"
    table(spark, sf_dir, "orders").sort("o_orderdate").write.option(
        "parquet.block.size", 256 * 1024
    ).parquet(path)
    facts = spark.read.parquet(path)
    text = facts.filter(F.date_format("o_orderdate", "yyyyMM") == "199810")
    span = facts.filter(
        (c("o_orderdate") >= F.lit("1998-10-01").cast("timestamp_ntz"))
        & (c("o_orderdate") < F.lit("1998-11-01").cast("timestamp_ntz"))
    )
    assert text.count() == span.count()
    print("month as text", median(lambda: sink(text)), flush=True)
    print("month as range", median(lambda: sink(span)), flush=True)

    hol = holidays(spark)
    dates = run(
        spark,
        sf_dir,
        "SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM {orders}",
    )
    opened = [
        r["as_of"]
        for r in report_calendar(spark, dates, hol, "anchor")
        .frame.filter("as_of = primer_dia_mes")
        .collect()
    ]

    def totals(days):
        cal = report_calendar(spark, days, hol, "anchor")
        src = facts.select("o_orderdate", c("o_totalprice").cast("decimal(18,2)").alias("v"))
        gated = month_gate(src, cal, "o_orderdate", guard=True)
        sink(totals_per_date(gated, cal.frame, {"v": weighted_sum(c("v"))}, {}))

    print(f"{len(opened)} months, one job", median(lambda: totals(opened)), flush=True)
    print(
        f"{len(opened)} months, one job each",
        median(lambda: [totals([d]) for d in opened], runs=1),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
