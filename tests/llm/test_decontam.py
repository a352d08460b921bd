import random
import tracemalloc

import numpy as np
import pytest

from mesada.llm.decontam import align, build_index, contaminated, find_items, without_contaminated
from tests.llm.conftest import prose

ITEMS = [(k, prose(1_000 + k, 25 + k)) for k in range(8)] + [(50, None), (51, "short"), (52, "")]


def distance_within(item, text):
    """Least edits of the item at any place of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def codes(text):
    return np.array([ord(c) for c in text], np.int64)


def edited(text, n, seed):
    r = random.Random(seed)
    chars = list(text)
    for _ in range(n):
        k = r.randrange(5, len(chars) - 5)
        what = r.choice("rid")
        if what == "r":
            chars[k] = "#"
        elif what == "i":
            chars.insert(k, "#")
        else:
            del chars[k]
    return "".join(chars)


@pytest.mark.parametrize("seed", range(25))
def test_banded_alignment(seed):
    r = random.Random(seed)
    item = "".join(r.choice("abcd") for _ in range(r.randrange(8, 40)))
    around = "".join(r.choice("abcd") for _ in range(30))
    at = r.randrange(0, 30)
    text = around[:at] + edited(item + "xxxxxxxxxxxx", r.randrange(3), seed)[:-12] + around[at:]
    edits, start, end = align(codes(item), codes(text), -len(item), len(text) + 2 * len(item))
    assert edits == distance_within(item, text)
    assert distance_within(item, text[start:end]) == edits


def test_places_of_exact_and_edited_items():
    index = build_index(ITEMS)
    texts, want = [prose(1, 300)], []
    for k, (item, text) in enumerate(ITEMS[:8]):
        budget = int(0.05 * len(text))
        texts.append(prose(k, 40) + " " + text + " " + prose(k + 30, 40))
        want.append((len(texts) - 1, item))
        texts.append(prose(k, 40) + "\n" + edited(text, budget // 2, k).upper() + "  end")
        want.append((len(texts) - 1, item))
        texts.append(prose(k, 40) + " " + edited(text, 4 * budget + 12, k) + " " + prose(k, 9))
    found = find_items(texts, index)
    assert [(r, index.ids[i]) for r, i, *_ in found] == want
    for r, i, start, end, edits, _ in found:
        place = " ".join(texts[r][start:end].lower().split())
        assert edits == distance_within(ITEMS[i][1].lower(), " ".join(texts[r].lower().split()))
        assert abs(len(place) - len(ITEMS[i][1])) <= edits


def test_every_place_within_budget_is_found():
    index = build_index(ITEMS)
    for seed in range(60):
        k = seed % 8
        text = edited(ITEMS[k][1], int(0.05 * len(ITEMS[k][1])), seed)
        assert any(index.ids[f[1]] == k for f in find_items([text], index)), seed


def test_each_copy_in_a_text_is_found():
    index = build_index([*ITEMS, (60, "ab" * 40), (61, "a" * 20)])
    for k, (item, text) in enumerate(ITEMS[:8]):
        budget = int(0.05 * len(text))
        copies = [text, edited(text, budget // 2, k), text.upper(), edited(text, budget // 2, k + 9)]
        whole, want = prose(k, 40), []
        for copy in copies:
            want.append((len(whole) + 1, len(whole) + 1 + len(copy)))
            whole += " " + copy + " " + prose(k + 30, 20)
        found = [f for f in find_items([prose(1, 90), whole], index) if index.ids[f[1]] == item]
        assert [f[0] for f in found] == [1] * 4
        for (start, end), (_, _, s, e, edits, _) in zip(want, found, strict=True):
            assert abs(s - start) + abs(e - end) <= 2 * budget and edits <= budget
        assert len([f for f in find_items([whole], index, every=False) if index.ids[f[1]] == item]) == 1
    for text, item, m in (("ab" * 100, 60, 80), ("a" * 207, 61, 20)):
        found = [f for f in find_items(["# " + text + " #"], index) if index.ids[f[1]] == item]
        assert len(found) == len(text) // m
        assert all(a[3] <= b[2] for a, b in zip(found, found[1:], strict=False))


def test_query_and_stage(spark, clashing, empty, docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    text = "é " * 20 + ITEMS[2][1] + " — tail " + ITEMS[3][1]
    more = spark.createDataFrame([(700, text), (700, text), (None, text), (701, None)],
                                 "doc_id long, text string")
    got = contaminated(more, bench).collect()
    assert sorted((str(r["id"]), r["item_id"]) for r in got) == sorted(
        [("700", 2), ("700", 3)] * 2 + [("None", 2), ("None", 3)]
    )
    assert all(text[r["start"] : r["end"]] == ITEMS[r["item_id"]][1] for r in got)
    blocks = contaminated(more, bench, block_chars=400).collect()
    assert sorted(map(str, blocks)) == sorted(map(str, got))
    assert [r["doc_id"] for r in without_contaminated(more, bench).collect()] == [701]
    out = without_contaminated(clashing, bench)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    assert contaminated(empty, bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0
    assert without_contaminated(docs, bench.limit(0)).count() == docs.count()


@pytest.mark.parametrize("seed", range(12))
def test_small_random_texts_against_brute_force(seed):
    """An item is found in a text if, and only if, some place of it is within the budget."""
    r = random.Random(seed)
    share = r.choice([0.05, 0.1, 0.2])
    items = [(k, "".join(r.choices("abc", k=r.randrange(1, 45)))) for k in range(25)]
    index = build_index(items, edits=share)
    texts = []
    for _ in range(25):
        text = "".join(r.choices("abc", k=r.randrange(0, 50)))
        item = r.choice(items)[1]
        if len(item) > 12:
            item = edited(item, r.randrange(0, 4), r.random())
        at = r.randrange(len(text) + 1)
        texts.append(text[:at] + item + text[at:])
    found = find_items(texts, index)
    want = {
        (row, k)
        for row, text in enumerate(texts)
        for k, item in items
        if distance_within(item, text) <= int(share * len(item))
    }
    assert {(row, index.ids[i]) for row, i, *_ in found} == want
    first = {row for row, *_ in find_items(texts, index, every=False)}
    assert first == {row for row, _ in want}
    for row, i, start, end, edits, _ in found:
        assert distance_within(items[i][1], texts[row][start:end]) == edits


def peak_mb(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_long_items_take_little_memory():
    r = random.Random(3)
    item = "".join(r.choices("abcdefgh ", k=8_000))
    index = build_index([(1, item)])
    text = "start " + item[:2_000] + "#" + item[2_001:7_000] + "#" + item[7_001:] + " end"
    found, peak = peak_mb(lambda: find_items([text], index))
    assert [(f[1], f[4]) for f in found] == [(0, 2)] and peak < 40


def test_items_that_share_a_prompt_take_little_memory():
    r = random.Random(4)
    prompt = "answer the following question as briefly as you can please "
    items = [(k, prompt + "".join(r.choices("abcdefghij ", k=60)).strip()) for k in range(2_000)]
    index = build_index(items)
    found, peak = peak_mb(lambda: find_items([prompt * 400, prompt * 30 + items[9][1][59:]], index))
    assert [(f[0], index.ids[f[1]]) for f in found] == [(1, 9)] and peak < 150


def test_short_items_are_searched_exactly():
    index = build_index([(1, "zq"), (2, "Short one"), (3, "x" * 20), (4, " \n"), (5, None)])
    texts = ["a zq b", "a short  ONE!", "short two", "y" + "x" * 9 + "#" + "x" * 10, "x" * 18]
    assert {(r, index.ids[i], e) for r, i, _, _, e, _ in find_items(texts, index)} == {
        (0, 1, 0), (1, 2, 0), (3, 3, 1),
    }


def test_equal_items_are_each_reported(spark):
    text = prose(77, 30)
    bench = spark.createDataFrame([(k, text) for k in range(40)] + [(99, "zzz")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "see " + text), (2, "none")], "doc_id long, text string")
    for chars in (1 << 20, 100):
        got = contaminated(docs, bench, block_chars=chars).collect()
        assert sorted(r["item_id"] for r in got) == list(range(40))
        assert without_contaminated(docs, bench, block_chars=chars).count() == 1
