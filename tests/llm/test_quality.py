import math

import pytest

from mesada.llm.quality import (
    GRID,
    RULES,
    choose_cutoffs,
    keep_quality,
    most_rejected,
    quality_rules,
    upper_bound,
)
from tests.llm.brute import WORD


def plain(text):
    found = WORD.findall(text)
    seen = {}
    for k in range(len(found) - 7):
        seen.setdefault(tuple(found[k : k + 8]), []).append(k)
    covered = {j for at in seen.values() if len(at) > 1 for k in at for j in range(k, k + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(found),
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(k, 1, 0) for k in range(12)] + [(24, 0, 0), (None, 1, 0), (777, 0, 1)],
        "doc_id long, quality int, toxic int",
    )


def test_measures_and_base(docs, rows, labels):
    got = quality_rules(docs, labels).collect()
    have = sorted(
        (
            str(r["id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
            r["n_repeat_words"], r["base_failed"],
        )
        for r in got
    )
    want = []
    for ident, text, *_ in rows:
        m = plain(text or "")
        want.append((str(ident), *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
    assert have == sorted(want)
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_bound_is_exact():
    for k, n in ((0, 10), (3, 50), (7, 1_000)):
        p = upper_bound(k, n, 0.01)
        tail = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
        assert tail == pytest.approx(0.01, rel=1e-6)
    k = most_rejected(2_000, 0.01, 0.001)
    assert upper_bound(k, 2_000, 0.001) <= 0.01 < upper_bound(k + 1, 2_000, 0.001)
    assert most_rejected(50, 0.01, 0.001) == -1


def test_cutoffs_hold_the_guarantee():
    counts = {"stratum": "en", "good": 5_000, "bad": 300}
    for rule in RULES:
        for j, cut in enumerate(GRID):
            counts[f"good_{rule}_{j}"] = 1_000 if cut < 0.1 else 2
            counts[f"bad_{rule}_{j}"] = 290 if cut <= 0.3 else 10
    chosen = choose_cutoffs([counts, counts | {"stratum": "xx", "good": 20}], 0.05, 0.1)
    assert chosen == [("en", rule, 0.3) for rule in RULES]


def test_learnt_rules_reject_symbols(spark):
    good = [(k, " ".join(f"w{k}x{j}" for j in range(30)), "en") for k in range(700)]
    bad = [(1_000 + k, " ".join(f"w{k}*{j} ##" for j in range(30)), "en") for k in range(50)]
    docs = spark.createDataFrame([*good, *bad, (5_000, bad[0][1], "zz"), (5_001, bad[1][1], None)],
                                 "doc_id long, text string, lang string")
    marks = [(k, 1, 0) for k, *_ in good] + [(k, 0, 0) for k, *_ in bad[:40]]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in keep_quality(docs, labels).collect()}
    assert kept == {k for k, *_ in good} | {5_000, 5_001}  # strata without labels: base only


def test_stage_keeps_columns(clashing, empty, labels):
    out = keep_quality(clashing, labels)
    assert out.columns == clashing.columns and out.count() > 0
    assert keep_quality(empty, labels).count() == quality_rules(empty, labels).count() == 0
    assert quality_rules(clashing, labels.limit(0)).count() == clashing.count()


def test_copies_of_a_labelled_text_count_once(spark):
    """300 copies of one good text with symbols are one exception, not 300."""
    good = [(k, " ".join(f"w{k}x{j}" for j in range(30)), "en") for k in range(700)]
    copies = [(2_000 + k, " ".join(f"v{j} ##" for j in range(30)), "en") for k in range(300)]
    bad = [(1_000 + k, " ".join(f"w{k}*{j} ##" for j in range(30)), "en") for k in range(50)]
    docs = spark.createDataFrame([*good, *copies, *bad], "doc_id long, text string, lang string")
    marks = [(k, 1, 0) for k, *_ in [*good, *copies]] + [(k, 0, 0) for k, *_ in bad[:40]]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in keep_quality(docs, labels).collect()}
    assert kept == {k for k, *_ in good}
