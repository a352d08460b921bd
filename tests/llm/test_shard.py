import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mesada.llm.shard import longest_walk, numbered, permuted, shard


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1_000, 1_023, 1_025, 4_097])
def test_permutation_of_row_numbers(spark, n):
    walk = longest_walk(spark, n, 7)
    got = spark.range(n).select(permuted(F.col("id"), n, 7, walk).alias("p")).collect()
    assert sorted(r["p"] for r in got) == list(range(n))
    if n > 100:
        assert sum(r["p"] == k for k, r in enumerate(got)) < 20


def test_numbers_do_not_depend_on_partitions(spark, docs):
    rows = docs.select("doc_id", "n_chars")
    one, n = numbered(rows.repartition(1), 16)
    other, m = numbered(rows.repartition(5), 16)
    assert n == m == rows.count()
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert sorted(r["row_number"] for r in one.collect()) == list(range(n))


def test_shards_of_all_rows(docs, rows):
    got = shard(docs, shards=5).collect()
    want = Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    assert Counter((r["id"], r["size"], r["text_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert set(by) == set(range(5))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(s) for s in by.values()]
    assert max(sizes) - min(sizes) <= 1


def test_many_equal_rows(spark):
    docs = spark.range(5_000).select(F.lit(1).alias("doc_id"), F.lit("same").alias("text"))
    got = shard(docs, shards=7).collect()
    places = {(r["shard"], r["slot"]) for r in got}
    assert len(got) == len(places) == 5_000


def test_no_python_in_the_plan(docs):
    plan = shard(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_and_clashing(empty, clashing):
    assert shard(empty).count() == 0
    assert shard(clashing).count() == clashing.count()
