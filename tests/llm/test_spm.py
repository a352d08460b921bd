import hashlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from mesada.llm import spm
from mesada.llm.spm import CharacterMap, Model, encoded, encoding_digests

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  ", "a b", " a  b ", "a▁b ▁▁ c\t\nd", "漢字 テスト 😀 x", "naïve\n\ncafé", "\x00z"]


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return Model(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def compare(model, library, text):
    ids = next(model.encode_all([text]))
    assert ids.tolist() == library.encode(text)
    assert model.decode(ids) == library.decode(library.encode(text))
    start, end = model.spans(text, ids)
    data = text.encode()
    assert (start[1:] == end[:-1]).all() and (not len(ids) or (start[0], end[-1]) == (0, len(data)))
    theirs = library.encode(text, return_type="proto").pieces
    for k, piece in enumerate(theirs):
        if model.kinds[ids[k]] != 6:  # the library gives a byte piece its whole character
            assert (start[k], end[k]) == (piece.begin, piece.end)
        elif end[k] > start[k]:
            assert data[start[k] : end[k]] == bytes([int(piece.piece[3:5], 16)])


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_library(model, library, text):
    compare(model, library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab \n▁é漢😀.T")), max_size=40))
def test_as_the_library_on_any_text(model, library, text):
    compare(model, library, text)


def test_words_are_not_cut_where_pieces_span_blanks(model, library):
    assert model.by_words
    whole = Model.__new__(Model)
    whole.__dict__.update(model.__dict__, by_words=False)
    for text in TEXTS:
        assert next(whole.encode_all([text])).tolist() == library.encode(text)


def compiled(rules):
    """A double array for a few rules, built by first fit; its layout is that of the format."""
    texts, places = b"", {}
    for key, value in rules.items():
        places[key] = len(texts)
        texts += value + b"\0"
    units, used = {0: 0}, {0}

    def fit(children, here):
        base = 256
        while any((base ^ c) in used for c in children) or (base ^ here) >= 1 << 21:
            base += 256
        return base

    def grow(prefix, at):
        tails = {k[len(prefix)] for k in rules if k.startswith(prefix) and len(k) > len(prefix)}
        leaf = prefix in rules
        base = fit(tails | ({0} if leaf else set()), at)
        units[at] |= (at ^ base) << 10 if at else base << 10
        if leaf:
            units[at] |= 256
            used.add(base)
            units[base] = 1 << 31 | places[prefix]
        for c in tails:
            used.add(base ^ c)
            units[base ^ c] = c
        for c in tails:
            grow(prefix + bytes([c]), base ^ c)

    grow(b"", 0)
    size = max(units) + 256
    array = np.zeros(size, "<u4")
    for k, v in units.items():
        array[k] = v
    return (4 * size).to_bytes(4, "little") + array.tobytes() + texts


RULES = {b"A": b"a", "ﬁ".encode(): b"fi", "é".encode(): "é".encode(), b"AB": b"x", b"\t": b" "}


def test_longest_prefix_and_source_places(model):
    trie = CharacterMap(compiled(RULES))
    assert trie.longest(b"ABC", 0) == (2, b"x") and trie.longest(b"AC", 0) == (1, b"a")
    assert trie.longest("ﬁt".encode(), 0) == (3, b"fi") and trie.longest(b"z", 0) is None
    other = Model.__new__(Model)
    other.__dict__.update(model.__dict__, map=trie, by_words=False)
    other.strip = False
    out, places = other.normalise("ABﬁ A")
    assert out.decode() == "▁xfi▁a"
    assert places.tolist() == [0, 0, 0, 0, 2, 2, 5, 5, 5, 6, 7]
    other.strip = True
    out, places = other.normalise(" \tA \t b ")
    assert out.decode() == "▁a▁b" and places[3] == 2 and places[-2] == 6


def test_query_and_stage(docs, rows, clashing, empty, library):
    got = sorted(map(tuple, encoding_digests(docs, PATH).select(
        "id", "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes").collect()), key=str)
    want = []
    for ident, text, *_ in rows:
        ids = library.encode(text or "")
        sha = [hashlib.sha256(s.encode()).hexdigest()
               for s in (",".join(map(str, ids)), library.decode(ids))]
        want.append((ident, len(ids), *sha, len((text or "").encode())))
    assert got == sorted(want, key=str)
    out = encoded(clashing, PATH)
    assert out.columns[: len(clashing.columns)] == clashing.columns
    assert out.columns[len(clashing.columns) :] == [
        "_token_ids", "token_starts", "token_ends", "decoded",
    ]
    for r in out.collect():
        assert r["_token_ids"] == library.encode(r["text"] or "")
    assert encoded(empty, PATH).count() == encoding_digests(empty, PATH).count() == 0


def test_batches_of_long_texts_leave_in_small_runs(spark, monkeypatch):
    """What a text becomes is several times as large; a batch is not held so as a whole."""
    with open(PATH, "rb") as f:
        shipped = SimpleNamespace(value=f.read())
    runs = []
    monkeypatch.setattr(spm, "_shipped", lambda docs, path: shipped)
    docs = spark.range(0).selectExpr("id doc_id", "'' text")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run) or self)
    encoded(docs, PATH)
    texts = [f"{k} some words of a text. " * 4_000 for k in range(40)]
    whole = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    out = list(runs[0](iter([whole])))
    table = pa.Table.from_batches(out)
    assert table["doc_id"].to_pylist() == list(range(40))
    assert table["text"].to_pylist() == table["decoded"].to_pylist() == texts
    assert max(sum(len(t) for t in b.column(1).to_pylist()) for b in out) <= 1 << 20
