import math
import zlib
from collections import Counter

import numpy as np
import pytest

from mesada.llm import lm
from mesada.llm.trie import EliasFano, PairTrie
from tests.llm.brute import words

MU = 20.0


def plain(rows):
    end = None
    tokens = [[*words(t or ""), end] for _, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows]
    train = [t for t, h in zip(tokens, held, strict=True) if not h]
    count = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip([end, *t], t, strict=False))
    n, z = sum(count.values()), sum(count.values()) + 0.5 * (len(count) + 1)
    out = []
    for (ident, *_), t, h in zip(rows, tokens, held, strict=True):
        base = sum(math.log10((count[w] + 0.5) / z) for w in t)
        score = sum(
            math.log10((pairs[v, w] + MU * (count[w] + 0.5) / z) / (count[v] + MU))
            for v, w in zip([end, *t], t, strict=False)
        )
        out.append((ident, h, len(t), sum(count[w] > 0 for w in t), n, base, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("heavy,block", [(1_024, 12 << 20), (20, 3_000)])
def test_scores(docs, rows, monkeypatch, heavy, block):
    monkeypatch.setattr(lm, "HEAVY", heavy)
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    got = sorted(map(tuple, lm.language_scores(docs, mu=MU).collect()), key=str)
    want = plain(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-12)
    assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=1e-3)


def test_no_training_texts_and_empty(spark, empty, clashing):
    alone = next(k for k in range(50) if zlib.crc32(str(k).encode()) % 5 == 1)
    df = spark.createDataFrame([(alone, "a b")], "doc_id long, text string")
    (r,) = lm.language_scores(df).collect()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (True, 3, 0, 0)
    assert r["base_score"] == r["score"] == 0
    assert lm.language_scores(empty).count() == 0
    assert lm.language_scores(clashing).count() == clashing.count()


def test_packing():
    rng = np.random.default_rng(2)
    word = np.sort(rng.integers(0, 40, 500, dtype=np.uint64))
    before = rng.integers(0, 30, 500, dtype=np.uint64)
    order = np.lexsort((before, word))
    word, before = word[order], before[order]
    code = rng.integers(0, 60_000, 500)
    w, b, pair, row, train = lm._unpack(lm._pack(word, before, code))
    assert (w[pair] == word).all() and (b[pair] == before).all()
    assert (row * 2 + train == code).all()


@pytest.mark.parametrize("n,top", [(1, 1), (10, 12), (500, 2**63), (5_000, 6_000)])
def test_elias_fano(tmp_path, n, top):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, top, n, dtype=np.uint64))
    made = EliasFano.build(values, str(tmp_path), "v")
    assert (made.get(np.arange(len(values))) == values).all()
    asked = np.concatenate([values, rng.integers(0, top, 200, dtype=np.uint64)])
    assert (made.successor(asked) == np.searchsorted(values, asked)).all()
    assert (made.find(asked) >= 0).tolist() == np.isin(asked, values).tolist()


def test_pair_trie(tmp_path):
    rng = np.random.default_rng(8)
    pairs = np.unique(rng.integers(0, 60, (900, 2), dtype=np.uint64) * np.uint64(7_919**4), axis=0)
    values = rng.random(len(pairs))
    trie = PairTrie(pairs[:, 0], pairs[:, 1], values, str(tmp_path))
    assert len(list(tmp_path.iterdir())) == 1  # its levels lie there
    assert np.allclose(trie.lookup(pairs[:, 0], pairs[:, 1]), values, atol=1e-3)
    assert np.isnan(trie.lookup(pairs[:, 0] + np.uint64(1), pairs[:, 1])).all()
    assert (trie.children_of(pairs[:, 0]) == [(pairs[:, 0] == p).sum() for p in pairs[:, 0]]).all()
    trie.close()
    assert not list(tmp_path.iterdir())
    none = np.zeros(0, np.uint64)
    empty = PairTrie(none, none, np.zeros(0), str(tmp_path))
    assert np.isnan(empty.lookup(pairs[:, 0], pairs[:, 1])).all()
