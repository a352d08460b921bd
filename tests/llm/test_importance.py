import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mesada.llm.importance import (
    PAIR_WEIGHT,
    features,
    gumbel,
    importance_sample,
    kth_largest,
    model_counts,
    with_target,
)
from mesada.llm.words import words_of
from tests.llm.brute import words


def test_words_and_pairs_are_those_of_the_texts(rows):
    texts = [t or "" for _, t, *_ in rows]
    for limit in (1, 300, 1 << 20):
        known: dict[int, str] = {}
        counts = []
        for block in words_of(pa.array(texts), limit):
            counts += block.count.tolist()
            found = [w for t in texts[block.first : block.last] for w in words(t)]
            assert len(found) == len(block.hashes)
            for w, h in zip(found, block.hashes.tolist(), strict=True):
                assert known.setdefault(h, w) == w
        assert counts == [len(words(t)) for t in texts]
        assert len(set(known.values())) == len(known)


def test_features_stay_inside_rows():
    texts = pa.array(["a b c", "", "d", "a b"])
    (block,) = words_of(texts)
    row, bucket = features(block)
    per = [sorted(bucket[row == r].tolist()) for r in range(4)]
    assert [len(p) for p in per] == [5, 0, 1, 3]
    assert set(per[3]) <= set(per[0])


@pytest.mark.parametrize("k", [1, 2, 7, 500, 1_999, 2_000])
def test_kth_largest(spark, k):
    r = random.Random(k)
    values = [r.choice([r.random(), 0.5, -1e6 * r.random()]) for _ in range(2_000)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    assert kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_kth_largest_without_enough(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    assert kth_largest(df, "v", 2) is None and kth_largest(df, "v", 0) is None


def test_counts_of_both_models(spark, docs, rows):
    from mesada.llm.common import id_and_text

    labels = spark.createDataFrame(
        [(0, 1, 0), (3, 1, 0), (3, 1, 0), (12, 1, 0), (5, 1, 1), (6, 0, 0), (None, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    own, raw = model_counts(with_target(id_and_text(docs, "doc_id", "text"), labels, 50))
    size = lambda t: max(0, 2 * len(words(t or "")) - 1)
    assert raw.sum() == sum(size(t) for _, t, *_ in rows)
    assert own.sum() == sum(size(t) for i, t, *_ in rows if i in (0, 3, 12))


def test_junk_goes_and_shares_hold(spark):
    good = [(k, " ".join(f"w{(k * j) % 97}" for j in range(60))) for k in range(300)]
    junk = [(1_000 + k, " ".join(f"z{(k * j) % 89}" for j in range(60))) for k in range(60)]
    blank = [(5_000, None), (5_001, " ")]
    docs = spark.createDataFrame([*good, *junk, *blank], "doc_id long, text string").repartition(4)
    marks = [(k, 1, 0) for k in range(0, 300, 2)] + [(k, 0, 0) for k in range(1_000, 1_030)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r["id"]: r for r in importance_sample(docs, labels).collect()}
    kept = {k for k, r in got.items() if r["kept"]}
    assert len(got) == 362 and len(kept) == round(360 * 150 / 180)
    assert all(got[k]["log_weight"] is None and not got[k]["kept"] for k in (5_000, 5_001))
    assert len(kept & {k for k, _ in junk}) < 5
    again = {r["id"]: r["key"] for r in importance_sample(docs, labels).collect()}
    assert all(math.isclose(again[k], r["key"], rel_tol=1e-9) for k, r in got.items() if r["key"])


def test_toxic_texts_go_and_clean_ones_stay(spark):
    def text(k, marks):
        r = random.Random(k)
        made = [f"w{r.randrange(300)}" for _ in range(150)]
        for mark in marks:
            made.insert(r.randrange(150), mark)
        return " ".join(made)

    toxic = range(1_000, 1_160)
    docs = [(k, text(k, ())) for k in range(1_000)]
    docs += [(k, text(k, ("idiot", "clown", "moron", "idiot"))) for k in toxic]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    marks = [(k, 1, 0) for k in range(0, 1_000, 2)] + [(k, 1, 1) for k in toxic if k % 2 == 0]
    marks += [(1, 1, None), (3, None, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    kept = {r["id"] for r in importance_sample(docs, labels).where("kept").collect()}
    assert len(kept) == 1_000
    held_out = {k for k in toxic if k % 2}
    assert len(kept & held_out) <= 0.1 * len(held_out)
    assert len([k for k in kept if k < 1_000 and k % 2]) >= 0.95 * 500


def test_empty_and_clashing(empty, clashing, spark):
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    assert importance_sample(empty, labels).count() == 0
    got = importance_sample(clashing, labels.limit(0)).collect()
    assert len(got) == clashing.count()
    assert all(r["kept"] == (r["n_features"] > 0) for r in got)
    assert np.isfinite([r["key"] for r in got if r["key"] is not None]).all()


def plain_sample(rows, target, share, noise, scale=100.0):
    """(log weight, key, kept) by the definition; words and pairs are texts here, not buckets."""
    def parts(text):
        found = words(text or "")
        return [Counter(found), Counter(zip(found, found[1:], strict=False))]

    ratios = []
    for kind in (0, 1):
        raw, own = Counter(), Counter()
        for ident, text in rows:
            raw += parts(text)[kind]
            if ident in target:
                own += parts(text)[kind]
        buckets = 1 << 18
        n_own, n_raw = sum(own.values()) + buckets, sum(raw.values()) + buckets
        ratios.append({f: math.log((own[f] + 1) / n_own) - math.log((raw[f] + 1) / n_raw) for f in raw})
    out = []
    for ident, text in rows:
        one, two = parts(text)
        size = sum(one.values()) + PAIR_WEIGHT * sum(two.values())
        total = sum(n * ratios[0][f] for f, n in one.items())
        total += PAIR_WEIGHT * sum(n * ratios[1][f] for f, n in two.items())
        out.append(scale * total / size if size else None)
    keys = [None if w is None else w + noise[i] for w, (i, _) in zip(out, rows, strict=True)]
    full = sorted((k for k in keys if k is not None), reverse=True)
    last = full[round(share * len(full)) - 1]
    return [(w, k, k is not None and k >= last - 1e-9) for w, k in zip(out, keys, strict=True)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_weight_key_and_verdict_against_brute_force(spark, kind):
    r = random.Random(8)
    rows = [(k, " ".join(f"w{int(r.paretovariate(0.6)) % 12}" for _ in range(r.randrange(40)))) for k in range(120)]
    rows = [(k if kind == "long" else f"doc-{k}", t) for k, t in rows] + [(None, "w1 w2 w3")]
    ids = [i for i, _ in rows if i is not None]
    target = set(ids[:40])
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)
    marks = [(i, 1, 0) for i in target] + [(i, 0, 0) for i in ids[60:80]]
    labels = spark.createDataFrame(marks, f"doc_id {kind}, quality int, toxic int")
    got = {x["id"]: x for x in importance_sample(docs, labels).collect()}
    noise = docs.select("doc_id", gumbel(F.col("doc_id"), 11).alias("g")).collect()
    want = plain_sample(rows, target, 40 / 60, {x["doc_id"]: x["g"] for x in noise})
    assert len(got) == len(rows)
    for (ident, _), (weight, key, kept) in zip(rows, want, strict=True):
        row = got[ident]
        if weight is None:
            assert row["log_weight"] is None and row["key"] is None and not row["kept"]
            continue
        assert math.isclose(row["log_weight"], weight, abs_tol=1e-6)
        assert math.isclose(row["key"], key, abs_tol=1e-6) and row["kept"] == kept
