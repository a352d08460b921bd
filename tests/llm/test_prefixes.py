import hashlib
import heapq
import os
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mesada.llm.prefixes import prefix_trie
from mesada.llm.spill import SpillingQueue
from mesada.llm.turns import numbered, with_openings

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """Each conversation's turns after rebuilding."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, role, hashlib.md5(text.encode()).digest())
            own[c].append((order, (role, text)))
    own = {c: [t for _, t in sorted(found)] for c, found in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain(rows):
    convs = rebuilt(rows)
    members, chars = defaultdict(list), {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(lambda: [0, 0, 0])  # children, leaves, saved
    for node in sorted(members, key=len, reverse=True):
        mine = below[node]
        mine[1] = mine[1] or 1
        if node:
            mine[2] += (len(members[node]) - 1) * len(node[-1][1])
            up = below[node[:-1]]
            up[0], up[1], up[2] = up[0] + 1, up[1] + mine[1], up[2] + mine[2]
    out = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(found), len(node), parent, len(found), *below[node], digest))
    return Counter(out)


def bag(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    return Counter(tuple(r) for r in df.select(*names.split()).collect())


def some_rows(seed, n=150, words=3):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(400), n):
        for turn in range(r.randint(1, 9)):
            text = "open" if turn == 0 and r.random() < 0.5 else r.choice("é 漢 bb c".split()[:words])
            rows.append((c, turn, r.choice(["user", "assistant"]) if turn > 1 else "user", text))
    return rows


def odd_rows():
    return [
        (600, None, None, None), (600, None, "user", "later?"), (600, 0, "", ""),
        (600, 0, "", ""), (None, 1, "user", "lost"), (None, None, None, None),
        (700, 3, "user", "x" * 5_000), (701, 1, "user", "only"), (702, 2, "user", None),
        *[(703, k, "user", "turn") for k in (5, 5, 5, 1)],
    ]


@pytest.mark.parametrize(
    "levels, heavy, limit", [(4_096, 65_536, 1 << 17), (3, 65_536, 8), (2, 20, 4), (1, 4, 2)]
)
def test_matches_brute_force(spark, levels, heavy, limit):
    rows = some_rows(1) + odd_rows()
    # A conversation longer than many blocks, and near copies that leave it at some depth.
    for k, cut in enumerate((70, 70, 41, 41, 6)):
        rows += [(800 + k, t, "user", f"t{t}" if t < cut else f"{k}-{t}") for t in range(70)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = prefix_trie(*with_openings(numbered(df)), levels, heavy, limit)
    assert bag(got) == plain(rows)


def test_ids_of_the_last_turn_in_order_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr("mesada.llm.prefixes.CHUNK", 40)
    rows = [(c, 0, "user", "same") for c in range(-150, 600)]
    got = prefix_trie(*with_openings(numbered(spark.createDataFrame(rows, SCHEMA).repartition(3))))
    want = range(-150, 600)  # every base exists, so all have the one turn
    digest = hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
    assert {(r["depth"], r["n_convs"]) for r in got.collect()} == {(0, 750), (1, 750)}
    assert got.where("depth = 1").first()["ends_sha256"] == digest


def test_absent_bases_and_turnless_conversations(spark):
    rows = [(c, 0, "user", "hi") for c in range(101, 130)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefix_trie(*with_openings(numbered(df)))
    assert bag(got) == plain(rows)
    assert got.where("depth = 0").first()["n_convs"] == 29


def test_text_ids_without_rebuilding(spark):
    rows = [("b", 1, "user", "x"), ("a", 1, "user", "x"), ("a", 2, "user", "y")]
    df = spark.createDataFrame(rows, SCHEMA.replace("conv_id long", "conv_id string"))
    turns = numbered(df).withColumnsRenamed({"pos": "d", "total": "length"})
    convs = turns.where("d = 1").select("conv", "length")
    got = prefix_trie(convs, turns)
    assert {(r["conv_id"], r["depth"], r["n_convs"], r["saved_tokens"]) for r in got.collect()} == {
        ("a", 0, 2, 1), ("a", 1, 2, 1), ("a", 2, 1, 0),
    }


def test_empty_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(*with_openings(numbered(empty))).count() == 0
    rows = some_rows(4, 20)
    df = spark.createDataFrame(rows, SCHEMA)
    for k, name in enumerate("conv pos total part row d k1 length chars content".split()):
        df = df.selectExpr("*", f"{k} AS `{name}`")
    assert bag(prefix_trie(*with_openings(numbered(df)))) == plain(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), max_size=120), st.integers(2, 9))
def test_spilling_queue_is_a_queue(tmp_path_factory, steps, limit):
    folder = str(tmp_path_factory.mktemp("spill"))
    queue, heap = SpillingQueue(folder, limit), []
    for k, step in enumerate(steps):
        if step is None and heap:
            assert queue.least() == heap[0]
            assert queue.pop() == heapq.heappop(heap)
        elif step is not None:
            queue.push((step, k, 0, 0, 0))
            heapq.heappush(heap, (step, k, 0, 0, 0))
            assert len(queue.heap) <= limit
    while heap:
        assert queue.pop() == heapq.heappop(heap)
    assert queue.least() is None
    queue.close()
    assert not os.listdir(folder)  # runs are deleted when read
