import datetime as dt

import pytest
from report_fixture import relations, rows

from mesada import report_calendar, transfer_detail, transfer_totals
from mesada.operators.totals import positional
from mesada.profiles import PROFILES, get_profile
from mesada.sources.readers import (
    CatalogSource,
    FileSource,
    JdbcSource,
    open_relations,
    read_holidays,
    read_table,
)
from mesada.sources.schemas import RELATIONS, schema_of
from mesada.sources import writers
from mesada.sources.writers import read_report_file, write_report, write_report_file


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Every relation as parquet, once as snapshot and once as live data."""
    root = tmp_path_factory.mktemp("rel")
    children = [(1, 102, "98B", 50)]
    plan = {102: (1, ("81X", None, None, 1, None, None))}
    for source, kids in (("snapshot", []), ("live", children)):
        data = rows(children=kids, plan=plan)
        data["diasfestivos"] = [(dt.date(2024, 1, 1),)]
        for name, df in relations(spark, data).items():
            df.write.parquet(f"{root}/{source}/{name}")
    return root


def sources(base):
    return {s: FileSource(f"{base}/{s}") for s in ("snapshot", "live")}


def test_read_table_has_the_fixed_schema(spark, base):
    for name in RELATIONS:
        df = read_table(spark, name, FileSource(f"{base}/snapshot"))
        want = [(f.name, f.dataType) for f in schema_of(name)]
        assert [(f.name, f.dataType) for f in df.schema] == want
    assert read_holidays(spark, FileSource(f"{base}/snapshot")).count() == 1


def test_names_match_in_any_case_and_types_are_cast(spark, tmp_path):
    spark.sql("select 1 as ID, 'x' as nombre, 5 as extra").write.json(f"{tmp_path}/banco.json")
    df = read_table(spark, "banco", FileSource(str(tmp_path), "json", ".json"))
    assert df.schema == schema_of("banco") and tuple(df.first()) == (1, "x")


def test_catalog_source(spark):
    spark.sql("select 3 as Id, 'tres' as Nombre").createOrReplaceTempView("banco")

    class Views(CatalogSource):
        def read(self, spark, name):
            return spark.table(name)

    assert tuple(read_table(spark, "banco", Views("x")).first()) == (3, "tres")
    spark.catalog.dropTempView("banco")


def test_live_children_in_v2_only(spark, base, holidays):
    assert get_profile("v2").sources == {"informacionpm": "live"}
    cal = report_calendar(spark, [dt.date(2024, 2, 1)], holidays)
    for profile, want in (("v1", "81X - $1,00"), ("v2", "98B - $50,00  ")):
        t = open_relations(spark, sources(base), profile)
        # Same batch rule for both, to see the same request.
        from dataclasses import replace

        p = replace(PROFILES[profile], cutoff_op=">")
        got = {r["SOLICITUD"]: r["NUMEROCUENTA"] for r in transfer_detail(t, cal, p).collect()}
        assert got[102] == want
    assert len(open_relations(spark, sources(base))) == len(RELATIONS)
    with pytest.raises(KeyError):
        open_relations(spark, sources(base))["nada"]


def test_jdbc_options():
    src = JdbcSource(
        "jdbc:x", "esquema", {"user": "u"}, {"seguros": ("idSeguros", 1, 1000, 64)}
    )
    opts = src.options("seguros")
    assert opts["dbtable"] == "esquema.seguros" and opts["user"] == "u"
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"]) == (
        "idSeguros", "1", "1000",
    )
    assert opts["numPartitions"] == "64"
    assert "numPartitions" not in src.options("banco")
    with pytest.raises(ValueError, match="operaciones: give `ranges`"):
        src.options("operaciones")
    assert src.options("banco")["customSchema"] == "Id int, Nombre string"


def lines(path):
    return [
        line
        for part in sorted(path.glob("part-*.csv"))
        for line in part.read_text().splitlines()
    ]


def test_report_file_keeps_null_and_empty_apart(spark, tmp_path):
    df = spark.sql("select 'TOTAL' a, cast(null as string) b, '' c, ' 81A - $1,00  ' d, 2 e")
    write_report(df, str(tmp_path / "a"))
    assert lines(tmp_path / "a") == ['TOTAL,,""," 81A - $1,00  ",2']
    write_report(df, str(tmp_path / "b"), null_value="NULL", empty_value="", sep=";")
    assert lines(tmp_path / "b") == ["TOTAL;NULL;; 81A - $1,00  ;2"]
    back = spark.read.csv(str(tmp_path / "a"), nullValue="", emptyValue="")
    assert back.count() == 1 and len(back.columns) == 5


def test_report_files_are_in_order(spark, base, holidays, tmp_path):
    cal = report_calendar(spark, [dt.date(2024, 2, 1)], holidays)
    df = transfer_detail(open_relations(spark, sources(base)), cal, "v1", with_as_of=False)
    write_report(df, str(tmp_path / "o"))
    assert [x.split(",")[0] for x in lines(tmp_path / "o")] == ["101", "105"]
    write_report(
        transfer_totals(open_relations(spark, sources(base)), cal, "v1", with_as_of=False),
        str(tmp_path / "t"),
    )
    assert lines(tmp_path / "t") == ["TOTAL,,,,,,$31200000"]


def test_positional_placeholders(spark):
    df = positional(spark.sql("select 1 as x"), [None, None, "x"], "T", "")
    assert df.columns == ["c01", "c02", "x"] and tuple(df.first()) == ("T", "", 1)


def hidden(folder):
    return [p.name for p in folder.iterdir() if p.name.startswith(".") and "crc" not in p.suffix]


def test_one_flat_file_equals_the_parts(spark, tmp_path):
    df = spark.range(0, 5000, 1, 7).selectExpr(
        "id", "if(id % 3 = 0, null, concat(' ñ', id, ' ')) a", "if(id % 5 = 0, '', 'x,\"y') b",
        "cast(id / 7 as decimal(18,2)) c",
    ).orderBy("id")
    write_report(df, str(tmp_path / "parts"))
    write_report_file(df, str(tmp_path / "one.csv"))
    parts = b"".join(p.read_bytes() for p in sorted((tmp_path / "parts").glob("part-*.csv")))
    assert len(sorted((tmp_path / "parts").glob("part-*.csv"))) > 1
    assert (tmp_path / "one.csv").read_bytes() == parts
    back = read_report_file(spark, str(tmp_path / "one.csv"), df.schema)
    assert back.exceptAll(df).count() == 0 and back.count() == 5000
    assert hidden(tmp_path) == []


def test_header_once_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    df = spark.range(0, 40, 1, 5).selectExpr("id as `OP`", "id as `CC;\"CE`")
    write_report_file(df, path, sep=";", header=True)
    lines = (tmp_path / "r.csv").read_text().splitlines()
    assert lines[0] == 'OP;"CC;\\"CE"' and len(lines) == 41 and lines[1:] == [f"{k};{k}" for k in range(40)]
    with pytest.raises(FileExistsError):
        write_report_file(df, path)
    write_report_file(df.limit(0), path, header=True, mode="overwrite")
    assert (tmp_path / "r.csv").read_text() == 'OP,"CC;\\"CE"\n'
    with pytest.raises(ValueError, match="mode"):
        write_report_file(df, path, mode="append")


def test_failed_run_leaves_the_old_file(spark, tmp_path, monkeypatch):
    path = tmp_path / "r.csv"
    good = spark.range(3)
    write_report_file(good, str(path))
    bad = spark.range(0, 9, 1, 3).selectExpr("if(id = 7, raise_error('broken'), id) v")
    with pytest.raises(Exception, match="broken"):
        write_report_file(bad, str(path), mode="overwrite")

    def torn(spark, files, folder, out):
        out.write(bytearray(b"half"))
        raise OSError("no space")

    monkeypatch.setattr(writers, "_append_parts", torn)
    with pytest.raises(OSError, match="no space"):
        write_report_file(good, str(path), mode="overwrite")
    assert path.read_text() == "0\n1\n2\n" and hidden(tmp_path) == []


def test_joining_many_parts_keeps_memory_flat(spark, tmp_path):
    # About 100 MB in 60 parts.
    df = spark.range(0, 60_000, 1, 60).selectExpr("id", "repeat(sha2(cast(id as string), 512), 13) t")
    runtime = spark._jvm.java.lang.Runtime.getRuntime()

    def used():
        spark._jvm.System.gc()
        return runtime.totalMemory() - runtime.freeMemory()

    before = used()
    write_report_file(df, str(tmp_path / "big.csv"))
    assert used() - before < 30 << 20
    assert (tmp_path / "big.csv").stat().st_size > 95 << 20
    assert read_report_file(spark, str(tmp_path / "big.csv"), "id long, t string").count() == 60_000
