"""Reads of a remote source: predicates of the gate, of split points and of the sent keys."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import DataFrameReader
from report_fixture import relations, rows

from mesada import disbursement_detail, disbursement_totals, report_calendar, transfer_detail, transfer_totals
from mesada.sources import pushdown
from mesada.sources.pushdown import (
    FACTS,
    FILTER_RANGES,
    NOTHING,
    Restricted,
    fact_predicates,
    gate_predicate,
    key_ranges,
    merged_ranges,
    only_keys,
    pushed_relations,
    quantile_points,
    range_predicates,
    read_points,
    write_points,
)
from mesada.sources.readers import FileSource, JdbcSource, open_relations, split_predicates
from mesada.sources.writers import write_by_month

AS_OF = dt.date(2024, 2, 1)
GATE = "fechaenvio >= TIMESTAMP '2024-01-01 00:00:00' AND fechaenvio < TIMESTAMP '2024-02-01 00:00:00'"


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("remote")
    data = rows(children=[(1, 102, "98B", 50)], plan={102: (1, ("81X", None, None, 1, None, None))})
    data["diasfestivos"] = [(dt.date(2024, 1, 1),)]
    for name, df in relations(spark, data).items():
        df.write.parquet(f"{root}/{name}")
    return root


def test_gate_becomes_a_predicate(spark, holidays):
    cal = report_calendar(spark, [AS_OF], holidays)
    assert gate_predicate(cal, "fechaenvio") == GATE
    assert gate_predicate(cal, "fechaenvio", "=").endswith("< TIMESTAMP '2024-01-05 00:00:00'")
    assert gate_predicate(report_calendar(spark, cal.frame, holidays), "fechaenvio") is None
    source = JdbcSource("jdbc:x", "s", points={FACTS: ("solicitud", (10, 20))})
    assert fact_predicates(source, "g") == [
        "(g) AND (solicitud < 10 OR solicitud IS NULL)",
        "(g) AND (solicitud >= 10 AND solicitud < 20)",
        "(g) AND (solicitud >= 20)",
    ]
    assert fact_predicates(FileSource("x"), "g") == ["g"]


def test_jdbc_reads_one_task_for_each_predicate(spark, monkeypatch):
    seen = []

    def jdbc(self, url, table, predicates=None, properties=None, **rest):
        seen.append((url, table, predicates, properties))
        return spark.range(1)

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    source = JdbcSource(
        "jdbc:x", "s", {"user": "u"}, {"seguros": ("idSeguros", 1, 9, 4)},
        points={"seguros": ("idSeguros", (5,))},
    )
    source.read(spark, "seguros")
    Restricted(source, {"operaciones": ["idOperaciones >= 3 AND idOperaciones <= 4"]}).read(
        spark, "operaciones"
    )
    (url, table, splits, properties), (_, other, ranges, _) = seen
    assert (url, table, other) == ("jdbc:x", "s.seguros", "s.operaciones")
    assert splits == ["idSeguros < 5 OR idSeguros IS NULL", "idSeguros >= 5"]
    assert ranges == ["idOperaciones >= 3 AND idOperaciones <= 4"]
    # Types are final and even ranges are out of the way.
    assert properties["user"] == "u" and "customSchema" in properties
    assert not {"url", "dbtable", "partitionColumn", "numPartitions"} & set(properties)
    with pytest.raises(ValueError, match="operaciones: give `ranges`"):
        source.read(spark, "operaciones")


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Stand-in for a remote table: keys bunched at the low end, one hot key, some missing."""
    path = str(tmp_path_factory.mktemp("skewed") / "t")
    spark.range(0, 60_000, 1, 4).selectExpr(
        "case when id % 6 = 0 then 77 when id % 101 = 3 then null"
        " else cast(pow(1.0003, id) as bigint) + id % 50 end as clave"
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_points_split_a_skewed_key_evenly(spark, skewed, tmp_path):
    points = quantile_points(skewed, "clave", 16)
    assert len(points) <= 15 and points == tuple(sorted(set(points)))
    predicates = split_predicates("clave", points)
    counts = [skewed.where(p).count() for p in predicates]
    assert sum(counts) == skewed.count()
    hot = next(k for k, p in enumerate(predicates) if skewed.where(f"({p}) AND clave = 77").count())
    rest = [n for k, n in enumerate(counts) if k != hot]
    assert max(rest) < 2 * sum(rest) / len(rest)
    # Even ranges of the same number leave most rows in one.
    low, high = skewed.selectExpr("min(clave)", "max(clave)").first()
    width = (high - low) // 16
    even = split_predicates("clave", [low + k * width for k in range(1, 16)])
    assert max(skewed.where(p).count() for p in even) > 3 * max(rest)
    write_points(spark, {"seguros": ("idSeguros", points)}, str(tmp_path / "points"))
    assert read_points(spark, str(tmp_path / "points")) == {"seguros": ("idSeguros", points)}
    assert quantile_points(skewed.limit(0), "clave") == ()
    assert split_predicates("clave", ()) == ["1 = 1"]


def test_ranges_hold_the_keys_and_skip_what_lies_between(spark):
    keys = spark.sql(
        "select explode(array(1, 2, 3, 900, 901, 902, 5000000000, null)) a, cast(null as int) b"
    )
    found = key_ranges(keys, ["a", "b"], 8)
    assert found["b"] == [] and range_predicates("b", []) == [NOTHING]
    assert sum(n for *_, n in found["a"]) == 7 and len(found["a"]) <= 8
    inside = {k for k in (1, 2, 3, 900, 901, 902, 5000000000) for a, b, _ in found["a"] if a <= k <= b}
    assert len(inside) == 7
    assert not any(a <= k <= b for k in (500, 10_000) for a, b, _ in found["a"])


def test_reports_on_cut_relations_are_equal(spark, base, holidays):
    source = {"snapshot": FileSource(str(base)), "live": FileSource(str(base))}
    both = (disbursement_detail, transfer_detail)
    totals = (disbursement_totals, transfer_totals)
    for day, profile, reports in (
        (AS_OF, "v2", both), (dt.date(2024, 2, 18), "v1", totals),
    ):
        cal = report_calendar(spark, [day], holidays)
        full = open_relations(spark, source, profile)
        cut = pushed_relations(spark, source, cal, profile, most=3)
        for report in reports:
            want = Counter(map(tuple, report(full, cal, profile).collect()))
            assert Counter(map(tuple, report(cut, cal, profile).collect())) == want
    # What no request of the months uses is not read.
    cal = report_calendar(spark, [AS_OF], holidays)
    cut = pushed_relations(spark, source, cal, "v1", most=64)
    full = open_relations(spark, source, "v1")
    assert 0 < cut["operaciones"].count() < full["operaciones"].count()
    assert {r[0] for r in cut[FACTS].selectExpr("date_format(fechaenvio, 'yyyy-MM')").collect()} == {"2024-01"}
    none = pushed_relations(spark, source, report_calendar(spark, [dt.date(2001, 1, 1)], holidays))
    assert none["originacion"].count() == none["seguros"].count() == 0


def test_ranges_reach_a_file_scan(spark, base, holidays):
    source = {"snapshot": FileSource(str(base))}
    cal = report_calendar(spark, [AS_OF], holidays)
    cut = pushed_relations(spark, source, cal, "v1", most=1)
    text = cut["operaciones"]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(idOperaciones" in text and "LessThanOrEqual(idOperaciones" in text


def test_merged_ranges_leave_the_widest_gaps_open():
    ranges = [(1, 2, 5), (4, 4, 1), (100, 120, 7), (130, 131, 2), (900, 900, 1)]
    assert merged_ranges(ranges[::-1], 3) == [(1, 4, 6), (100, 131, 9), (900, 900, 1)]
    assert merged_ranges(ranges, 1) == [(1, 900, 16)]
    assert merged_ranges(ranges, 5) == merged_ranges(ranges, 64) == ranges
    assert merged_ranges([]) == []


def test_a_file_filter_stays_short(spark, base, holidays, monkeypatch):
    """A filter of 64 ranges is too long a method for Java to compile."""
    source = {"snapshot": FileSource(str(base))}
    cal = report_calendar(spark, [AS_OF], holidays)
    many = [(10 * k, 10 * k + 1, 1) for k in range(40)]
    monkeypatch.setattr(pushdown, "key_ranges", lambda keys, columns, most=64: {c: many for c in columns})
    cut = pushed_relations(spark, source, cal, "v1")
    frames = [cut[n] for n in ("operaciones", "desembolso", "originacion_solicitudes", "cliente")]
    frames.append(only_keys(spark.range(1000), "id", spark.range(3).toDF("k")))
    for df in frames:
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert 0 < max(line.count(" >= ") for line in lines) <= FILTER_RANGES
    # A database still gets all ranges, one a task.
    asked = []
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, predicates=None, **rest:
        (asked.append((table, predicates)), FileSource(str(base)).read(spark, table[2:]))[1])
    remote = JdbcSource("jdbc:x", "s", points={FACTS: ("solicitud", (10,))})
    pushed_relations(spark, {"snapshot": remote}, cal, "v1")["operaciones"]
    table, predicates = asked[-1]
    assert table == "s.operaciones" and len(predicates) == 40


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The same sendings by month, in order of the request and as they come."""
    root = tmp_path_factory.mktemp("facts")
    df = spark.sql("""
      select (id * 7919) % 100003 * 2 as solicitud, sha2(cast(id as string), 256) as resto,
        timestamp_ntz'2024-01-01 00:00:00' + (id % 60) * interval '1' day as fechaenvio
      from range(0, 120000, 1, 6)""")
    for name, sort in (("sorted", "solicitud"), ("plain", None)):
        write_by_month(df, str(root / name), "fechaenvio", sort_col=sort, group_bytes=256 << 10)
    return root


def rows_read(df):
    """Rows that come out of the scan, after row groups are passed over."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    nodes, scans = [plan], []
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            scans.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        nodes += [children.apply(k) for k in range(children.size())]
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            nodes.append(node.plan())
    return sum(scans)


def test_files_sorted_by_request_are_read_in_part(spark, stored):
    near = spark.range(4_000, 4_400, 2).toDF("k")
    few = spark.sql("select explode(array(10L, 90000L, 150000L, 150001L, 7L)) k")
    apart = spark.sql("select explode(array(11L, 13L, 90001L)) k")  # odd: no request has them
    for keys, share in ((near, 0.15), (few, 0.25), (apart, 0.02)):
        found = {}
        for name in ("sorted", "plain"):
            df = spark.read.parquet(str(stored / name))
            found[name] = only_keys(df, "solicitud", keys)
            want = df.join(keys, df["solicitud"] == keys["k"], "left_semi")
            assert found[name].exceptAll(want).count() == want.exceptAll(found[name]).count() == 0
        assert rows_read(found["sorted"]) <= share * 120_000 < rows_read(found["plain"])
    none = only_keys(spark.read.parquet(str(stored / "sorted")), "solicitud", near.limit(0))
    assert none.count() == 0
