import random
import zlib

import pyarrow as pa
import zstandard

from mesada.llm import langid
from mesada.llm.langid import Classifier, Languages, identify, language_predictions, learn, letters

SYLLABLES = {
    "en": "the ing and ough tion er th wh ly ed".split(),
    "de": "sch ung der und ein keit ich ver ü ö".split(),
    "fr": "eau que ment oi ou é è le ç re".split(),
}


def invented(lang, seed, n):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 3))) for _ in range(n))


def labelled():
    out = []
    for k in range(360):
        lang = ("en", "en", "de", "fr")[k % 4]
        out.append((k, invented(lang, k, 5 + k % 90), lang, "web", 0))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_held_out_accuracy(spark):
    rows = labelled()
    got = language_predictions(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    right = [r for r in held if r["lang_pred"] == truth[r["id"]]]
    assert len(held) > 60 and len(right) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_held_out_rows_are_not_seen(spark):
    rows = labelled()
    lies = [
        (i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else g, "other", 9)
        for i, t, g, *_ in rows
    ]
    a, b = (
        {r["id"]: tuple(r) for r in language_predictions(spark.createDataFrame(x, SCHEMA)).collect()}
        for x in (rows, lies)
    )
    assert a == b


def plain_judge(model, text):
    """Sizes from fresh compressors, block by block."""
    data = letters(pa.array([text]))[0].as_py().encode()
    sizes = []
    for content in model.contents:
        kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        total = 0
        for k in range(0, len(data), 1024):
            pack = zstandard.ZstdCompressor(
                level=3, dict_data=kept, write_content_size=False, write_dict_id=False
            )
            total += len(pack.compress(data[k : k + 1024]))
        sizes.append(total)
    return sizes


def test_sizes_are_those_of_the_whole_text(spark):
    model = learn(spark.createDataFrame(labelled(), SCHEMA))
    assert model.names[0] == "en" and set(model.names) == {"en", "de", "fr"}
    judge = Classifier(model)
    for text in (invented("de", 1, 3), invented("fr", 2, 4000), invented("en", 3, 90) + " 123 ½"):
        data = letters(pa.array([text]))[0].as_py().encode()
        assert judge.sizes(data) == plain_judge(model, text)
    # A text that turns to another language after a long start is judged by its whole length.
    turned = invented("fr", 5, 300) + " " + invented("de", 6, 3000)
    assert judge.judge(letters(pa.array([turned]))[0].as_py())[0] == "de"


def test_narrow_margins_are_rejected(spark):
    model = learn(spark.createDataFrame(labelled(), SCHEMA))
    texts = [invented("en", 8, 200), invented("en", 9, 40) + " " + invented("de", 9, 40), "q"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    got = {r["k"]: r for r in identify(df, model, margin=0.1).collect()}
    assert not got[0]["rejected"] and got[1]["rejected"] and got[2]["rejected"]
    assert all(r["lang_pred"] in model.names for r in got.values())


def test_edges(spark, clashing, empty):
    assert language_predictions(empty).count() == 0
    got = language_predictions(clashing).collect()
    assert len(got) == clashing.count()
    by_id = {r["id"]: r for r in got if r["id"] is not None}
    for k, text in ((20, None), (21, ""), (22, " \t\n "), (16, None)):
        row = clashing.where(f"doc_id = {k}").select("text").first()
        if row and (row[0] is None or not any(c.isalpha() for c in row[0])):
            assert (by_id[k]["lang_pred"], by_id[k]["score"]) == ("und", 0.0)
    assert not [r for r in got if r["id"] is None and r["held_out"]]
    digits = spark.createDataFrame([(1, "12 ½ ²"), (2, None), (3, "é")], "id int, text string")
    model = Languages(("en",), (b"the and of",))
    found = {r["id"]: (r["lang_pred"], r["score"]) for r in identify(digits, model).collect()}
    assert found == {1: ("und", 0.0), 2: ("und", 0.0), 3: ("en", 1.0)}
    none = identify(digits, Languages((), ())).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    named = digits.selectExpr("*", "1 AS lang_pred", "2 AS score", "3 AS rejected")
    assert identify(named, model).columns[-3:] == ["_lang_pred", "_score", "_rejected"]


def test_one_text_fills_no_dictionary_alone(spark, monkeypatch):
    monkeypatch.setattr(langid, "PIECES", 4)
    long = invented("en", 1, 50_000)
    rows = [(k, long, "en", "", 0) for k in range(50)] + [(99, invented("en", 2, 30), "en", "", 0)]
    model = learn(spark.createDataFrame(rows, SCHEMA))
    assert model.names == ("en",) and len(model.contents[0]) <= 4 * (langid.PIECE * 2 + 1)
