from collections import Counter

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from mesada.llm.components import connected_components
from mesada.llm.simhash import fingerprint, keep_one, simhash_components, tile_links
from tests.llm.brute import components, words


def plain_fingerprint(text, size=4):
    found = words(text)
    if not found:
        return 0
    shingles = [" ".join(found[k : k + size]) for k in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_of_whole_texts(rows):
    for _, text, *_ in rows:
        assert fingerprint(text or "") == plain_fingerprint(text or "")


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="ab \n İÉ", max_size=60))
def test_fingerprint_of_any_text(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_tile_links_connect_what_is_near():
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (400, 3), dtype=np.uint64)
    fps = np.unique(rng.choice(seeds, 400) ^ np.bitwise_xor.reduce(flips, axis=1))
    for a, b in ((fps, None), (fps[:150], fps[150:])):
        pool = fps.tolist() if b is None else None
        u, v = tile_links(a, b, 4)
        assert len(u) < len(fps)  # a forest
        if pool:
            want = components(
                pool, [(x, y) for x in pool for y in pool if x < y and (x ^ y).bit_count() <= 4]
            )
            got = components(pool, list(zip(u.tolist(), v.tolist(), strict=True)))
            assert got == want


def test_components_match_brute_force(spark, docs, rows):
    got = Counter(
        (r["id"], r["fp"] % (1 << 64), r["component_id"])
        for r in simhash_components(docs, tile=4).collect()
    )
    prints = [plain_fingerprint(t or "") for _, t, *_ in rows]
    distinct = sorted(set(prints))
    near = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 4]
    label = components(distinct, near)
    least = {}
    for (ident, *_), fp in zip(rows, prints, strict=True):
        if ident is not None:
            least[label[fp]] = min(ident, least.get(label[fp], ident))
    want = Counter(
        (ident, fp, least.get(label[fp])) for (ident, *_), fp in zip(rows, prints, strict=True)
    )
    assert got == want


def test_keep_one_of_each_class(clashing, docs, rows):
    kept = keep_one(clashing)
    assert kept.columns == clashing.columns
    classes = {(r["id"], r["fp"]): r["label"] for r in simhash_components(docs).collect()}
    labels = [classes[r["doc_id"], _signed(r["text"])] for r in kept.collect()]
    assert len(labels) == len(set(labels)) == len(set(classes.values()))


def _signed(text):
    fp = plain_fingerprint(text or "")
    return fp - (1 << 64) if fp >> 63 else fp


def test_empty(empty):
    assert simhash_components(empty).count() == 0
    assert keep_one(empty).count() == 0


def test_long_chain_and_hub_are_one_component(spark):
    chain = [(k, k + 1) for k in range(1, 40)]
    hub = [(1_000, k) for k in range(1_001, 1_060)]
    got = connected_components(spark.createDataFrame([*chain, *hub, (7, 7)], "u long, v long"))
    labels = {r["node"]: r["label"] for r in got.collect()}
    assert set(labels) == {*range(1, 41), *range(1_000, 1_060)}
    assert {labels[k] for k in range(1, 41)} == {1}
    assert {labels[k] for k in range(1_000, 1_060)} == {1_000}
