import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from mesada.operators.lookups import SPREAD, bridge_lookup, lookup, with_spread
from mesada.operators.ranked import (
    account_number,
    fold_fixed,
    fold_ranked,
    ranked_children,
    ranked_fold,
    with_rank,
)

DDL = "parent bigint, id bigint, op string, amount decimal(18,2)"


def fold(spark, children, style="plain", n=2):
    df = spark.createDataFrame(children, DDL).repartition(n)
    kids = ranked_children(df, ["parent"], ["id"], ["id", "op", "amount"])
    rows = kids.select("parent", fold_ranked(F.col("children"), "op", "amount", style)).collect()
    out = {r[0]: r[1] for r in rows}
    windows = ranked_fold(df, ["parent"], ["id"], "op", "amount", style, first=["id", "op"])
    assert windows.columns == ["parent", "id", "op", "folded"]
    assert {r[0]: r[3] for r in windows.collect()} == out  # both forms make the same texts
    return out


def one(spark, *pairs, style="plain"):
    return fold(spark, [(1, i, op, None if v is None else D(v)) for i, (op, v) in enumerate(pairs)],
                style)[1]


@pytest.mark.parametrize(
    "pairs, want",
    [
        ([("81A", 100)], "81A - $100,00  "),
        ([("81A", None)], "81A - $0,00  "),
        ([("81A", 100), ("98B", 50)], "81A - $100,00 // 98B - $50,00"),
        ([("81A", 100), ("98B", 0)], "81A - $100,00 // 98B"),
        ([("81A", -100), ("98B", 50), ("75C", 10)], "81A - $100,00 // 98B - $50,00//75C - $10,00"),
        # A middle child without an operation gets no separator before it.
        ([("A", 1), ("B", 2), (None, 3), ("C", 4)], "A - $1,00 // B - $2,00 - $3,00//C - $4,00"),
        ([("A", 1), (None, 2)], "A - $1,00   - $2,00"),
        ([(None, 1), ("B", 2)], " - $1,00 // B - $2,00"),
    ],
)
def test_golden_fold(spark, pairs, want):
    assert one(spark, *pairs) == want


def test_draft_fold(spark):
    pairs = [("A", None), ("B", D("1500.6")), ("C", 0)]
    assert one(spark, *pairs, style="grouped") == "A - $ // B - $1,501//C"
    assert one(spark, ("A", None), style="grouped") == "A - $0  "


def test_ten_children_only(spark):
    text = one(spark, *[(f"K{i}", 1) for i in range(12)])
    assert text.count("K") == 10 and "K9" in text and not text.endswith("//")


def ref_fold(kids):
    """Brute force on one parent's children in order."""

    def money(v):
        return f"{abs(v or D(0)):.2f}".replace(".", ",")

    kids = kids[:10]
    ops = [k[0] for k in kids] + [None] * (11 - len(kids))
    out = (ops[0] or "") + " - $" + money(kids[0][1]) + (" // " if ops[1] is not None else "  ")
    for i in range(1, len(kids)):
        amount = money(kids[i][1])
        out += (ops[i] or "") + ("" if amount == "0,00" else " - $" + amount)
        if i < 9 and ops[i + 1] is not None:
            out += "//"
    return out


def test_fold_against_brute_force_with_a_hot_parent(spark):
    rnd = random.Random(7)
    rows, kids = [], {}
    for i in range(3000):
        parent = 1 if i % 3 == 0 else rnd.randrange(2, 300)
        op = rnd.choice([None, "81", "98", "75"])
        op = op and f"{op}{i}"
        amount = rnd.choice([None, D(0), D(rnd.randrange(-99999, 99999)) / 100])
        key = rnd.randrange(10**9) * 10000 + i
        rows.append((parent, key, op, amount))
        kids.setdefault(parent, []).append((key, op, amount))
    rows.append((None, 1, "lost", D(1)))
    got = fold(spark, rows, n=4)
    assert None not in got
    assert got == {p: ref_fold([k[1:] for k in sorted(v)]) for p, v in kids.items()}


def test_rank_and_null_order(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 3)], "p int, o int")
    rows = with_rank(df, ["p"], ["o"]).collect()
    assert {r["o"]: r["conteo"] for r in rows} == {3: 1, 5: 2, None: 3}


def test_fixed_fold(spark):
    df = spark.createDataFrame(
        [("81X", D(10), "82Y", D(5), "83Z", D(1)), ("81X", D(10), None, None, "83Z", D(1)),
         ("81X", D(-10), "82Y", None, None, None), (None, None, None, None, None, None)],
        "a string, va decimal(18,2), b string, vb decimal(18,2), c string, vc decimal(18,2)",
    )
    ops, values = [F.col(x) for x in "abc"], [F.col(f"v{x}") for x in "abc"]
    rows = df.select(fold_fixed(ops, values), fold_fixed(ops, values, "grouped")).collect()
    assert [tuple(r) for r in rows] == [
        ("81X - $10,00 // 82Y - $5,00 // 83Z - $1,00", "81X - $10 // 82Y - $5 // 83Z - $1"),
        ("81X - $10,00", "81X - $10"),
        ("81X - $10,00 // 82Y - $0,00", "81X - $10 // 82Y - $"),
        (" - $0,00", " - $"),
    ]


def test_account_number_branches(spark):
    rows = [
        (1, 1, None, "fijo"), (1, 6, None, "cuenta"), (1, 6, 7, "hijos"), (0, 1, 7, "cuenta"),
        (None, 1, None, "cuenta"),
    ]
    df = spark.createDataFrame(rows, "plan int, kind int, child int, want string")
    got = df.select(
        account_number(
            F.col("plan"), F.col("kind"), F.col("child"), F.lit("hijos"), F.lit("fijo"),
            F.lit("cuenta"),
        ),
        "want",
    ).collect()
    assert all(a == b for a, b in got)


def test_lookups(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, k int")
    bridge = spark.createDataFrame([(10, 100), (20, 999)], "bk int, ref int")
    dim = spark.createDataFrame([(100, "uno")], "dk int, name string")
    left = bridge_lookup(facts, bridge, dim, "k", "bk", "ref", "dk", "left")
    assert sorted(map(tuple, left.collect()), key=str) == [
        (1, 10, "uno"), (2, 20, None), (3, None, None),
    ]
    inner = bridge_lookup(facts, bridge, dim, "k", "bk", "ref", "dk")
    assert [tuple(r) for r in inner.collect()] == [(1, 10, "uno")]
    assert lookup(facts, bridge, "k", "bk", "left").columns == ["id", "k", "ref"]


def test_spread_keeps_matches_and_scatters_missing_keys(spark):
    left = spark.sql(
        "select id, case when id % 3 = 0 then null when id % 3 = 1 then id else -id end k "
        "from range(300)"
    )
    right = with_spread(spark.sql("select id - 150 as rk from range(300)"), "rk")
    left = with_spread(left, "k", "id")
    missing = left.filter("k is null")
    assert missing.select(SPREAD).distinct().count() == 100
    right = right.withColumnRenamed(SPREAD, "rs")
    plain = left.join(right, left.k == right.rk, "left").filter("rk is not null").count()
    spread = left.join(right, (left.k == right.rk) & (left[SPREAD] == right.rs), "left")
    assert spread.count() == 300
    assert spread.filter("rk is not null").count() == plain == 100


@pytest.mark.parametrize("style", ["plain", "grouped"])
@pytest.mark.parametrize("null_concat", [False, True])
def test_both_forms_of_the_fold_are_equal(spark, style, null_concat):
    rnd = random.Random(11)
    rows = []
    for i in range(1500):
        op = rnd.choice([None, "", "81", "98"])
        amount = rnd.choice([None, D(0), D(10**15), D(rnd.randrange(-99999, 99999)) / 100])
        rows.append((rnd.randrange(200), i, op, amount))
    df = spark.createDataFrame(rows, DDL).repartition(3)
    kids = ranked_children(df, ["parent"], ["id"], ["id", "op", "amount"])
    first = F.get(F.col("children"), F.lit(0))
    want = kids.select(
        "parent", first["id"], first["op"],
        fold_ranked(F.col("children"), "op", "amount", style, null_concat),
    )
    got = ranked_fold(df, ["parent"], ["id"], "op", "amount", style, null_concat, first=["id", "op"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_fold_needs_one_shuffle_one_sort_and_no_lambda(spark):
    df = spark.range(0, 1000, 1, 4).selectExpr(
        "id % 50 parent", "id", "cast(id as string) op", "cast(id as decimal(18,2)) amount"
    )
    folded = ranked_fold(df, ["parent"], ["id"], "op", "amount")
    text = folded._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "lambda" not in text and "Aggregate" not in text
    # One sort for the limit in each map task, one for all windows.
    assert text.count("Sort [") == 2 and text.count("WindowGroupLimit") == 2
