"""Data selection by importance resampling over hashed n-grams.

Two generative models, bags of hashed words and, apart from them, of word pairs, are counted: one
of the target texts (labelled good and not toxic), one of all texts. The log ratio of the two,
summed over a text's n-grams, is tempered: divided by the text's length in n-grams and
multiplied by ``scale``. So every text counts as if it had ``scale`` n-grams, and length decides
nothing. A pair weighs ``PAIR_WEIGHT`` of a word, since most pairs are rare and would drown the
few words that mark a toxic text. The README has figures of both choices on held-out labels,
beside those of the plain sum. Gumbel noise made from the id is added, and the k largest sums
are a sample without replacement in proportion to the tempered weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesada.llm.common import checkpointed, id_and_text, map_text
from mesada.llm.words import U, Words, mix, words_of

BITS = 18
BINS = 1_024
PAIR_WEIGHT = 0.1


def features(block: Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word and every pair of neighbouring words of a block.

    Words have the buckets below 2^bits, pairs as many above them.
    """
    pairs = mix(block.hashes[:-1] * U(0x9E3779B97F4A7C15) + block.hashes[1:])
    whole = block.row[:-1] == block.row[1:]
    row = np.concatenate([block.row, block.row[:-1][whole]])
    bucket = (np.concatenate([block.hashes, pairs[whole]]) >> U(64 - bits)).astype(np.int64)
    bucket[len(block.hashes) :] += 1 << bits
    return row, bucket


def with_target(rows: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """rows (id, text) with ``target``: whether the id is among at most ``most`` target labels.

    Target labels are good and not toxic; they are drawn by hash. Ids may be of any type.
    """
    good = labels.where("quality = 1 and toxic = 0 and doc_id is not null")
    good = good.select(F.col("doc_id").alias("target_id")).distinct()
    drawn = good.orderBy(F.xxhash64("target_id", F.lit(7)), "target_id").limit(most)
    met = rows.join(F.broadcast(drawn), F.col("id") == F.col("target_id"), "left")  # most ids
    return met.select("id", "text", F.col("target_id").isNotNull().alias("target"))


def model_counts(rows: DataFrame, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each bucket over the target texts and all texts of rows (id, text, target)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, own = np.zeros(2 << bits, np.int64), np.zeros(2 << bits, np.int64)
        for batch in batches:
            good = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for block in words_of(batch.column(1)):
                row, bucket = features(block, bits)
                raw += np.bincount(bucket, minlength=2 << bits)
                hit = good[block.first + row]
                own += np.bincount(bucket[hit], minlength=2 << bits)
        full = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full), pa.array(raw[full]), pa.array(own[full])], names=["b", "raw", "own"]
        )

    counted = rows.mapInArrow(run, "b long, raw long, own long").groupBy("b")
    # At most 2^(bits + 1) rows: the models' size does not depend on the data.
    held = counted.agg(F.sum("raw").alias("raw"), F.sum("own").alias("own")).toArrow()
    raw, own = np.zeros(2 << bits), np.zeros(2 << bits)
    for name, counts in (("raw", raw), ("own", own)):
        counts[held["b"].to_numpy()] = held[name].to_numpy()
    return own, raw


def log_ratio(own: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of each bucket, both with one added to every count.

    Words and pairs are distributions of their own.
    """
    own, raw = (counts.reshape(2, -1) + 1 for counts in (own, raw))
    ratio = np.log(own / own.sum(1, keepdims=True)) - np.log(raw / raw.sum(1, keepdims=True))
    return ratio.ravel()


def mean_ratio(rows: DataFrame, ratio: np.ndarray, bits: int = BITS) -> DataFrame:
    """rows (id, text) as (id, n_features, mean_ratio); the mean is null without features."""
    weights = np.repeat([1.0, PAIR_WEIGHT], 1 << bits)
    held = rows.sparkSession.sparkContext.broadcast(ratio * weights)

    def work(texts: pa.Array) -> list:
        n, total, weight = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.ones(len(texts))
        for block in words_of(texts):
            row, bucket = features(block, bits)
            size = block.last - block.first
            many = np.bincount(row, minlength=size)
            n[block.first : block.last] = many
            full = block.count + PAIR_WEIGHT * (many - block.count)
            weight[block.first : block.last] = np.maximum(full, 1)
            total[block.first : block.last] = np.bincount(
                row, weights=held.value[bucket], minlength=size
            )
        mean = pa.array(total / weight, mask=n == 0)
        return [pa.array(n), mean]

    return map_text(rows, "text", work, "n_features long, mean_ratio double", drop_text=True)


def kth_largest(df: DataFrame, col: str, k: int) -> float | None:
    """The k-th largest value of a column, by counting ever smaller ranges in BINS bins.

    The driver sees BINS counts a round. Null if there are fewer than k values or k < 1.
    """
    held = df.where(F.col(col).isNotNull())
    low, high, n = held.agg(F.min(col), F.max(col), F.count("*")).first()
    if k < 1 or n < k:
        return None
    above = 0
    while low < high:
        step = (high - low) / BINS
        part = held.where(F.col(col).between(low, high))
        place = F.least(F.floor((F.col(col) - low) / step), F.lit(BINS - 1)).alias("bin")
        rows = part.groupBy(place).agg(
            F.count("*").alias("n"), F.min(col).alias("low"), F.max(col).alias("high")
        )
        for r in sorted(rows.collect(), key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                break
            above += r["n"]
        if (r["low"], r["high"]) == (low, high):
            # Neighbouring doubles that bins cannot part: the larger one's rows come first.
            upper = part.where(F.col(col) == high).count()
            return high if above + upper >= k else low
        low, high = r["low"], r["high"]
    return low


def gumbel(ident, seed: int):
    """Standard Gumbel noise from an id; null ids share one value."""
    bits = F.shiftrightunsigned(F.xxhash64(ident.isNull(), ident, F.lit(seed)), 11)
    return -F.log(-F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))))


def importance_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    share: float | None = None,
    scale: float = 100.0,
    seed: int = 11,
    most_targets: int = 50_000,
) -> DataFrame:
    """(id, n_features, log_weight, key, kept): a row per row of docs.

    ``share`` of the texts with features are kept; without one, the share of targets (good and
    not toxic) among the labels that say both. Target texts are those of at most
    ``most_targets`` labels; all other counts are over all texts. Ids may be of any simple type. Texts without words (null, empty, blank) have a null weight and are not
    kept; ties at the last place are all kept; repeated rows share weight, noise and verdict.
    Without labels everything with a word is kept; an empty table gives an empty result.
    """
    rows = id_and_text(docs, id_col, text_col)
    own, raw = model_counts(with_target(rows, labels, most_targets))
    means = mean_ratio(rows, log_ratio(own, raw))
    weight = F.col("mean_ratio") * F.lit(scale)
    scored = checkpointed(
        means.select("id", "n_features", weight.alias("log_weight")).withColumn(
            "key", F.col("log_weight") + gumbel(F.col("id"), seed)
        )
    )
    if share is None:
        said = labels.where("quality is not null and toxic is not null")
        target = (F.col("quality") == 1) & (F.col("toxic") == 0)
        share = said.agg(F.avg(target.cast("double"))).first()[0]
    n = scored.where("key is not null").count()
    last = kth_largest(scored, "key", round((1.0 if share is None else share) * n))
    kept = F.lit(False) if last is None else F.coalesce(F.col("key") >= F.lit(last), F.lit(False))
    return scored.withColumn("kept", kept)
