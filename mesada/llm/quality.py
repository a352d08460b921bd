"""Quality rules whose cutoffs are chosen under a guaranteed rate of false rejection.

Each rule rejects a text whose signal is over a cutoff. For every stratum the labelled good
texts are counted above each cutoff of a fixed grid; a cutoff may be used if the exact binomial
(Clopper-Pearson) upper bound of its false rejection rate is at most ``alpha`` / rules, at the
level ``delta`` / (strata x rules x cutoffs) (Bonferroni). Of these cutoffs the highest that
rejects at least 99 % as many labelled bad texts as any of them is taken. Exact copies of a text
count once, since the bound is one of independent texts. So with probability 1 - ``delta`` no stratum loses more than ``alpha`` of its good texts to the
chosen rules together. A rule with no such cutoff stays off in that stratum.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesada.llm.common import checkpointed, fresh, map_text
from mesada.llm.words import U, mix, words_of

WINDOW = 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a") : ord("z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True

FIELDS = (
    "word_chars",
    "n_words",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
    "n_letters",
    "n_marks",
)

#: name of each rule -> (numerator, denominator) of its signal
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_upper", "n_letters"),
    "marks": ("n_marks", "n_words"),
}
GRID = (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)


def _repeated_words(text: str) -> int:
    """Words in windows that the text holds twice or more."""
    words = text.encode().split()
    seen: dict[tuple, list[int]] = {}
    for k in range(len(words) - WINDOW + 1):
        seen.setdefault(tuple(words[k : k + WINDOW]), []).append(k)
    covered = np.zeros(len(words) + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            at = np.array(places)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + WINDOW, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def _dup_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.encode().split()]
    return len(lines) - len(set(lines))


def measure(texts: pa.Array) -> list:
    """FIELDS, as one struct, for each text of a string array without nulls."""
    rows = len(texts)
    out = np.zeros((8, rows), np.int64)
    for block in words_of(texts):
        part, n = block.data, block.last - block.first
        mine = slice(block.first, block.last)
        total = lambda hit, at=block: _per_row(at, hit, n)
        heads = (part & 0xC0) != 0x80  # one byte of every code point
        inside = np.zeros(len(part) + 1, np.int64)
        np.cumsum(heads, out=inside[1:])
        out[0, mine] = np.bincount(
            block.row, weights=inside[block.ends] - inside[block.starts], minlength=n
        )
        out[1, mine] = block.count
        out[2, mine] = total(SYMBOLS[part])
        out[5, mine] = total(_UPPER[part])
        out[6, mine] = total(_LETTER[part])
        out[7, mine] = total(_MARK[part])
        for k in _with_repeats(block):
            out[4, block.first + k] = _repeated_words(texts[block.first + int(k)].as_py())
        for k in _with_newlines(block):
            out[3, block.first + k] = _dup_lines(texts[block.first + int(k)].as_py())
    return [pa.StructArray.from_arrays([pa.array(c) for c in out], names=list(FIELDS))]


def _per_row(block, hit: np.ndarray, n: int) -> np.ndarray:
    """Hits inside words, by row: the characters counted here are never blank."""
    sums = np.zeros(len(hit) + 1, np.int64)
    np.cumsum(hit, out=sums[1:])
    return np.bincount(
        block.row, weights=sums[block.ends] - sums[block.starts], minlength=n
    ).astype(np.int64)


def _with_repeats(block) -> np.ndarray:
    """Rows in which two windows have one hash; only these are compared as words.

    Hashes ignore the case of A-Z, so they can only find too many rows.
    """
    m = len(block.hashes) - WINDOW + 1
    if m < 2:
        return np.zeros(0, np.int64)
    windows = np.zeros(m, np.uint64)
    for k in range(WINDOW):
        windows = windows * U(0x9E3779B97F4A7C15) + block.hashes[k : k + m]
    whole = block.row[:m] == block.row[WINDOW - 1 :]
    keys = mix(windows[whole] ^ mix(block.row[:m][whole].astype(np.uint64)))
    rows = block.row[:m][whole]
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order]
    return np.unique(rows[1:][keys[1:] == keys[:-1]])


def _with_newlines(block) -> np.ndarray:
    """Rows that hold a newline; a line break is a blank before a word or at the end."""
    places = np.flatnonzero(block.data == 10)
    if not len(places) or not len(block.starts):
        return np.zeros(0, np.int64)
    after = np.searchsorted(block.starts, places)
    known = after < len(block.starts)
    return np.unique(block.row[after[known]])


def signal(rule: str, m: str) -> Column:
    """The rule's signal from the struct of measures in column m."""
    above, below = RULES[rule]
    return F.col(f"{m}.{above}") / F.greatest(F.col(f"{m}.{below}"), F.lit(1))


def upper_bound(k: int, n: int, level: float) -> float:
    """Clopper-Pearson: the rate at which k or fewer of n have probability ``level``."""
    if n == 0 or k >= n:
        return 1.0
    log_choose = [
        math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in range(k + 1)
    ]

    def tail(p: float) -> float:
        lp, lq = math.log(p), math.log1p(-p)
        terms = [c + j * lp + (n - j) * lq for j, c in enumerate(log_choose)]
        top = max(terms)
        return top + math.log(sum(math.exp(t - top) for t in terms))

    low, high, target = max(k / n, 1e-12), 1.0, math.log(level)
    for _ in range(60):
        mid = (low + high) / 2
        if mid >= 1.0 or tail(mid) <= target:
            high = mid
        else:
            low = mid
    return high


def most_rejected(n: int, share: float, level: float) -> int:
    """The largest k with an upper bound of at most ``share``; -1 if there is none."""
    low, high = -1, int(share * n) + 1
    while high - low > 1:
        mid = (low + high) // 2
        if upper_bound(mid, n, level) <= share:
            low = mid
        else:
            high = mid
    return low


def choose_cutoffs(counts: list[dict], alpha: float, delta: float) -> list[tuple]:
    """(stratum, rule, cutoff) from the counts of labelled texts above each cutoff.

    ``counts``: one dict for each stratum: stratum, good, bad, and good_``rule``_j and
    bad_``rule``_j for the grid's j-th cutoff. Of the cutoffs that hold the guarantee, the
    highest is taken that rejects nearly as many bad texts as any of them.
    """
    level = delta / (max(1, len(counts)) * len(RULES) * len(GRID))
    share = alpha / len(RULES)
    out = []
    for held in counts:
        most = most_rejected(held["good"], share, level)
        for rule in RULES:
            safe = [j for j in range(len(GRID)) if held[f"good_{rule}_{j}"] <= most]
            caught = max((held[f"bad_{rule}_{j}"] for j in safe), default=0)
            if caught:
                j = max(j for j in safe if held[f"bad_{rule}_{j}"] >= 0.99 * caught)
                out.append((held["stratum"], rule, GRID[j]))
    return out


def base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < 20) | (
        100 * F.col(f"{m}.n_repeat_words") > 30 * F.col(f"{m}.n_words")
    )


def cutoffs(
    measured: DataFrame, labels: DataFrame, m: str, alpha: float, delta: float
) -> list[tuple]:
    """Cutoffs from every distinct labelled text of measured that passes the base.

    The driver gets one row of counts for each stratum: strata (languages) must be few.
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
    known = known.agg(F.min("quality").alias("quality"))
    held = measured.where(~base_failed(m) & F.col("stratum").isNotNull()).join(known, "id")
    # One of each text of a stratum; of its copies' differing labels the lower counts.
    signals = [signal(rule, m).alias(rule) for rule in RULES]
    held = held.groupBy("stratum", "same").agg(
        F.min("quality").alias("quality"), F.first(F.struct(*signals)).alias("s")
    )
    counts = [
        F.count_if((F.col("quality") == q) & (F.col(f"s.{rule}") > cut)).alias(f"{name}_{rule}_{j}")
        for q, name in ((1, "good"), (0, "bad"))
        for rule in RULES
        for j, cut in enumerate(GRID)
    ]
    rows = held.groupBy("stratum").agg(
        F.count_if(F.col("quality") == 1).alias("good"), *counts
    )
    return choose_cutoffs([r.asDict() for r in rows.collect()], alpha, delta)


def verdict(chosen: list[tuple], stratum: Column, m: str) -> Column:
    """True if no chosen rule of the row's stratum rejects it."""
    bad = F.lit(False)
    for name, rule, cut in chosen:
        bad = bad | (stratum.eqNullSafe(F.lit(name)) & (signal(rule, m) > F.lit(cut)))
    return ~bad


_STRUCT = "struct<" + ", ".join(f"{f}: bigint" for f in FIELDS) + ">"


def _measured(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """(id, stratum, same, m) of docs: the measures without the texts, and a hash of each."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{stratum_col}`").cast("string").alias("stratum"),
        F.struct(F.xxhash64(text), F.xxhash64(F.lit(1), text)).alias("same"),
        F.col(f"`{text_col}`").alias("text"),
    )
    return map_text(rows, "text", measure, f"m {_STRUCT}", drop_text=True)


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    alpha: float = 0.05,
    delta: float = 0.1,
) -> DataFrame:
    """One row per row of docs: id, stratum, the measures, base_failed, kept.

    The labelled texts choose the cutoffs. Null texts have no words and so fail; a null or
    unlabelled stratum has no rules of its own beyond the base. Labels of unknown or null ids
    count nothing; of an id's differing labels the lower counts; a repeated row counts as often
    as it occurs. Without labels only the base decides; an empty table gives an empty result.
    """
    measured = checkpointed(_measured(docs, id_col, text_col, stratum_col))
    chosen = cutoffs(measured, labels, "m", alpha, delta)
    return measured.select(
        "id",
        "stratum",
        "m.*",
        base_failed("m").alias("base_failed"),
        (~base_failed("m") & verdict(chosen, F.col("stratum"), "m")).alias("kept"),
    )


def keep_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    alpha: float = 0.05,
    delta: float = 0.1,
) -> DataFrame:
    """The rows of docs that quality_rules keeps, with the columns of docs."""
    measured = _measured(docs, id_col, text_col, stratum_col)
    chosen = cutoffs(measured, labels, "m", alpha, delta)
    (m,) = fresh(docs, "measures")
    judged = map_text(docs, text_col, measure, f"`{m}` {_STRUCT}")
    stratum = F.col(f"`{stratum_col}`").cast("string")
    kept = ~base_failed(m) & verdict(chosen, stratum, m)
    return judged.where(kept).select(*[f"`{c}`" for c in docs.columns])
