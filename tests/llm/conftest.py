import random

import pytest

WORDS = [
    "the of and for with ground river stone winter summer table chair house garden window light "
    "paper letter number street market people music water bread money morning evening night story"
][0].split()


@pytest.fixture(scope="session", autouse=True)
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(
        r.choice(WORDS) + (r.choice([".", ",", ""]) if k % 7 == 6 else "") for k in range(n)
    )


@pytest.fixture(scope="session")
def rows():
    """Documents with copies, near copies, nulls, blanks, ties and a long text."""
    base = [prose(k, 60 + 10 * k) for k in range(12)]
    texts = [
        *base,
        base[0],
        base[0] + " tail",
        base[1].upper(),
        base[2].replace("river", "rivér", 1),
        None,
        "",
        " \t\n ",
        "word",
        "two words",
        "Überraschung — 漢字 テスト 😀 naïve café\nline two\nline two\n\nline two",
        "a" * 700,
        "spam " * 200,
        "Head $$$ of *** the ### list &&& " * 40,
        prose(99, 9000),
    ]
    out = [(k, t, "en", "web", len(t or "")) for k, t in enumerate(texts)]
    return [*out, out[3], out[3], (None, base[4], None, None, None), (None, None, None, None, 0)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


CLASHES = "id kept fp label doc place g x m measures content row_number bucket block held id_ masked token_ids"


@pytest.fixture(scope="session")
def clashing(docs):
    """docs with columns of the names that operators use inside."""
    out = docs
    for k, name in enumerate(CLASHES.split()):
        out = out.selectExpr("*", f"{k} AS `{name}`")
    return out
