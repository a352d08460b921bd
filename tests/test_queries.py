"""Registered queries against their check SQL, on the smallest driver tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from analogue.oracle import rel
from analogue.queries import ORACLE, QUERIES
from analogue.relations import TABLES, relations
from check import bag
from mesada.sources.schemas import RELATIONS, schema_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")



@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) > 0 and {r["corte"] for r in rows} == {"240102.0900"}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cur = db.execute(entry.oracle_sql()[name])
    want = bag([d[0] for d in cur.description], cur.fetchall())
    assert bag(df.columns, df.collect()) == want


def test_derived_relations_are_the_same_in_both_engines(spark, db):
    t = relations(spark, SF)
    for name in RELATIONS:
        cols = [f.name for f in schema_of(name)]
        cur = db.execute(f"WITH {rel(name)} SELECT {', '.join(cols)} FROM {name}")
        want = bag([c.lower() for c in cols], cur.fetchall())
        got = bag([c.lower() for c in cols], t[name].select(*cols).collect())
        assert got == want, name
