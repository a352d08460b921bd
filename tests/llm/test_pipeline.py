import hashlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from check import bag
from mesada.llm.decontam import build_index, find_items
from mesada.llm.pii import find, mask
from mesada.llm.queries import ORACLE, QUERIES
from mesada.llm.quality import quality_rules
from mesada.llm.simhash import simhash_components
from mesada.llm.stages import MODEL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_in_order(spark, documents):
    """Each stage against its decisions on what it was given."""
    docs, columns = documents, documents.columns
    held = [{r["doc_id"]: r["text"] for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).checkpoint()
        assert docs.columns[: len(columns)] == columns
        held.append({r["doc_id"]: r["text"] for r in docs.collect()})
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality_rules(documents, labels).where("kept").collect()
    assert set(held[1]) == {r["id"] for r in judged}
    first = documents.where(F.col("doc_id").isin(list(held[1])))
    linked = simhash_components(first).collect()
    assert set(held[2]) == {r["component_id"] for r in linked}
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index, ids = build_index(bench), list(held[2])
    hit = {ids[f[0]] for f in find_items([held[2][k] for k in ids], index)}
    assert hit and set(held[3]) == set(held[2]) - hit
    assert held[4] == {k: mask(t, find(t)) for k, t in held[3].items()}
    library = sentencepiece.SentencePieceProcessor(model_proto=open(MODEL, "rb").read())
    for r in docs.collect():
        assert r["token_ids"] == library.encode(r["text"])
        assert r["decoded"] == library.decode(r["token_ids"])


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "token_ids" in out.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_over_the_whole_table(spark, documents, name):
    got = QUERIES[name](spark, SF)
    if name.startswith("op2_"):
        assert got.count() == spark.read.parquet(f"{SF}/pages.parquet").count()
    elif "doc_id" in got.columns and not name.startswith("op1_"):
        ids = Counter(r["doc_id"] for r in got.select("doc_id").collect())
        assert ids == Counter(r["doc_id"] for r in documents.select("doc_id").collect())
    assert set(ORACLE) <= set(QUERIES)


def test_encoding_digest_of_a_query(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op6_sentencepiece"](spark, SF).collect()}
    library = sentencepiece.SentencePieceProcessor(model_proto=open(MODEL, "rb").read())
    for r in documents.limit(20).collect():
        ids = ",".join(map(str, library.encode(r["text"])))
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(ids.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF)
    cur = db.execute(ORACLE[name])
    want = bag([d[0] for d in cur.description], cur.fetchall())
    assert bag(df.columns, df.collect()) == want
