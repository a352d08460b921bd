import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mesada.llm.pii import BASE_KINDS, find, luhn, mask, masked, mod97, pii_spans

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def plain(text):
    return [
        (kind, *m.span())
        for kind in BASE_KINDS
        for m in re.finditer(BASE[kind], text)
        if holds(kind, m[0])
    ]


def base(text):
    return [f[:3] for f in find(text) if f[0] in BASE_KINDS]


SAMPLES = [
    "mail a.b@c.de, x@y.z@w.v and @no.one or me@here",
    "ip 1.2.3.4 and 1.2.3.4.5.6.7.8 and 300.1.1.1 and 001.002.003.0004 and 1.2.3",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 378282246310005",
    "call +1 (555) 010-9999 or +49 30 1234567 or +1 2 or +5",
    "+1 555 0101 4111111111111111 10.0.0.1 z@z.zz",
    "1" * 3_000 + "." + "2" * 3_000,
    "a" * 5_000 + "@" + "b" * 10,
    "",
]


@pytest.mark.parametrize("text", SAMPLES)
def test_base_spans(text):
    assert base(text) == plain(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1234567890.@+-() ", max_size=60))
def test_base_spans_of_any_text(text):
    assert base(text) == plain(text)


def test_digits_of_other_scripts_are_none():
    assert base("٣.٣.٣.٣ +٣٣٣٣٣٣٣٣٣") == []


def test_checks():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("GB82 WEST 1234 5698 7654 32") and not mod97("GB82 WEST 1234 5698 7654 33")


def test_method_spans_need_a_check_or_context():
    key = "2f027ef9518c693e65d177e8be5b47f8a20db64f"
    kinds = lambda text: [f[0] for f in find(text)]
    assert "secret" in kinds(f'token = "{key}"') and "secret" not in kinds(f"commit {key}")
    assert kinds("to GB82 WEST 1234 5698 7654 32") == ["iban"]
    assert kinds("to GB82 WEST 1234 5698 7654 33") == []
    assert kinds("SSN 123-45-6789") == ["account"] and kinds("part 123-45-6789") == []


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("ES91 2100 0418 4502 0005 1332 BIC CAIXESBB", ["ES91 2100 0418 4502 0005 1332"]),
        ("to BE68539007547034 BIC GEBABEBB", ["BE68539007547034"]),
        ("ES9121000418450200051332 SWIFT", ["ES9121000418450200051332"]),
        ("NO93 8601 1117 947 BIC DNBANOKK", ["NO93 8601 1117 947"]),
        ("BE68 5390 0754 7034 GB82 WEST 1234 5698 7654 32 OK",
         ["BE68 5390 0754 7034", "GB82 WEST 1234 5698 7654 32"]),
        ("REF AB12 3456 7890 ES91 2100 0418 4502 0005 1332", ["ES91 2100 0418 4502 0005 1332"]),
        ("BE68 5390 0754 7035 BIC GEBABEBB", []),
        ("AB12 " * 3_000, []),
    ],
)
def test_iban_before_upper_case_words(text, want):
    assert [text[s:e] for k, s, e, _ in find(text) if k == "iban"] == want
    masks = mask(text, [f for f in find(text) if f[0] == "iban"])
    assert masks.count("<IBAN>") == len(want) and not any(w in masks for w in want)


def test_query_columns(spark, docs, rows):
    extra = [(900 + k, t, "en", "x", 0) for k, t in enumerate(SAMPLES)]
    df = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    got = sorted(map(tuple, pii_spans(df).drop("scores").collect()), key=str)
    want = []
    for ident, text, *_ in [*rows, *extra]:
        spans = plain(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        counts = [sum(k == kind for k, *_ in spans) for kind in BASE_KINDS]
        every = ",".join(f"{k}:{s}:{e}" for k, s, e, _ in find(text or ""))
        want.append((ident, *counts, hashlib.sha256(joined.encode()).hexdigest(), every))
    assert got == sorted(want, key=str)


def test_masks(clashing, empty):
    assert mask("x a@b.cc y", find("x a@b.cc y")) == "x <EMAIL> y"
    out = masked(clashing)
    assert out.columns == clashing.columns
    before = {r["doc_id"]: r["text"] for r in clashing.collect()}
    assert all(r["text"] == before[r["doc_id"]] for r in out.collect() if r["doc_id"] is not None)
    assert masked(empty).count() == pii_spans(empty).count() == 0
