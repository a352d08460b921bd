"""Ranked child rows of a parent, folded into one text.

The ranked rows are built once. `rank <= n` sits directly on the window, so Spark keeps at
most n rows per parent in each map task before the shuffle (WindowGroupLimit): a parent
that owns a large part of the table costs n rows per task, not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesada.functions.text import concat_text, money, nvl, without

# Fixed values of the folded text.
FIRST_SEPARATOR = " // "
SEPARATOR = "//"
AMOUNT_SIGN = " - $"
ZERO_AMOUNT = {"plain": " - $0,00", "grouped": " - $0"}
MAX_CHILDREN = 10


def with_rank(
    df: DataFrame, part: Sequence[str], order: Sequence[str], out: str = "conteo"
) -> DataFrame:
    """Row number within each group, in ascending order with NULLs last."""
    keys = [F.col(o).asc_nulls_last() for o in order]
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*part).orderBy(*keys)))


def ranked_children(
    df: DataFrame, part: Sequence[str], order: Sequence[str], cols: Sequence[str],
    n: int = MAX_CHILDREN, out: str = "children",
) -> DataFrame:
    """A2: one row per parent with an array of its first `n` children in order.

    Rank, limit and grouping share one hash partitioning on the parent: one shuffle.
    Children without a parent key can match no parent and are left out before it.
    """
    needed = list(dict.fromkeys([*part, *order, *cols]))
    keyed = df.select(*needed)
    for p in part:
        keyed = keyed.filter(F.col(p).isNotNull())
    ranked = with_rank(keyed, part, order).filter(F.col("conteo") <= n)
    return ranked.groupBy(*part).agg(
        F.sort_array(F.collect_list(F.struct("conteo", *cols))).alias(out)
    )


def _amount(value: Column, style: str) -> Column:
    return money(F.abs(value), style)


def fold_ranked(
    children: Column, op: str, value: str, style: str = "plain", null_concat: bool = False
) -> Column:
    """`op - $amount` of the first child, then the others, joined by separators.

    A child is followed by a separator when the next child has an operation. The amount
    of the first child always shows; later amounts vanish when zero or missing.
    """

    def text(*parts: Column) -> Column:
        return concat_text(*parts, null_concat=null_concat)

    def child(i: int) -> Column:
        return F.get(children, F.lit(i))

    sign = F.lit(AMOUNT_SIGN)
    alone = text(sign, _amount(nvl(child(0)[value], 0), style), F.lit(FIRST_SEPARATOR))
    followed = text(sign, _amount(child(0)[value], style), F.lit(FIRST_SEPARATOR))
    head = text(
        child(0)[op],
        F.when(child(1)[op].isNull(), without(alone, SEPARATOR)).otherwise(followed),
    )

    def later(c: Column, i: Column) -> Column:
        # `i` counts within the tail, so the next child sits at i + 2 of the whole array.
        amount = text(sign, _amount(nvl(c[value], 0), style))
        following = F.get(children, i + 2)[op]
        return text(
            nvl(c[op], ""),
            without(amount, ZERO_AMOUNT[style]),
            F.when(following.isNotNull(), F.lit(SEPARATOR)).otherwise(F.lit("")),
        )

    tail = F.transform(F.slice(children, 2, MAX_CHILDREN - 1), later)
    return text(head, F.array_join(tail, ""))


def ranked_fold(
    df: DataFrame, part: Sequence[str], order: Sequence[str], op: str, value: str,
    style: str = "plain", null_concat: bool = False, n: int = MAX_CHILDREN,
    first: Sequence[str] = (), out: str = "folded",
) -> DataFrame:
    """One row per parent with the folded text of its first `n` children.

    The text is that of `fold_ranked` over `ranked_children`; `first` names columns of the first
    child that are passed on. A separator stands before a child with an operation, so every
    child's text is made by generated code from its own row. The rank and the list of the later
    texts are windows over one shuffle and one sort of the children; no second grouping follows.
    """

    def text(*parts: Column) -> Column:
        return concat_text(*parts, null_concat=null_concat)

    keyed = df.select(*dict.fromkeys([*part, *order, op, value, *first]))
    for p in part:
        keyed = keyed.filter(F.col(p).isNotNull())
    ranked = with_rank(keyed, part, order).filter(F.col("conteo") <= n)
    place, sign = F.col("conteo"), F.lit(AMOUNT_SIGN)
    separator = F.when((place > 2) & F.col(op).isNotNull(), SEPARATOR).otherwise("")
    amount = without(text(sign, _amount(nvl(F.col(value), 0), style)), ZERO_AMOUNT[style])
    later = F.when(place > 1, text(separator, nvl(F.col(op), ""), amount))
    ranked = ranked.select(*dict.fromkeys([*part, *order, op, value, *first]), "conteo", later.alias("trozo"))
    whole = (
        Window.partitionBy(*part)
        .orderBy(*[F.col(o).asc_nulls_last() for o in order])
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    made = ranked.withColumns(
        {
            "resto": F.collect_list("trozo").over(whole),
            "sigue": F.max((place == 2) & F.col(op).isNotNull()).over(whole),
        }
    ).filter(place == 1)
    alone = text(sign, _amount(nvl(F.col(value), 0), style), F.lit(FIRST_SEPARATOR))
    followed = text(sign, _amount(F.col(value), style), F.lit(FIRST_SEPARATOR))
    head = text(
        F.col(op), F.when(F.col("sigue"), followed).otherwise(without(alone, SEPARATOR))
    )
    return made.select(*part, *first, text(head, F.array_join("resto", "")).alias(out))


def fold_fixed(
    ops: Sequence[Column], values: Sequence[Column], style: str = "plain",
    null_concat: bool = False,
) -> Column:
    """The same text from three fixed columns; the third needs the second."""

    def text(*parts: Column) -> Column:
        return concat_text(*parts, null_concat=null_concat)

    one, two, three = (
        text(op, F.lit(AMOUNT_SIGN), _amount(v, style)) for op, v in zip(ops, values, strict=True)
    )
    sep = F.lit(FIRST_SEPARATOR)
    return (
        F.when(ops[1].isNotNull() & ops[2].isNotNull(), text(one, sep, two, sep, three))
        .when(ops[1].isNotNull(), text(one, sep, two))
        .otherwise(one)
    )


def account_number(
    plan: Column, detail_type: Column, first_child_id: Column, folded: Column, fixed: Column,
    account: Column,
) -> Column:
    """Which of the three account texts a transfer shows."""
    has_child = first_child_id.isNotNull()
    return (
        F.when((plan == 1) & (detail_type == 1) & ~has_child, fixed)
        .when((plan == 1) & has_child, folded)
        .otherwise(account)
    )
