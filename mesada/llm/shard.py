"""Shuffle and shard by a Feistel permutation of global row numbers, in DataFrame functions only.

Rows are numbered 0 .. n-1 from their content alone: by bucket (a hash of the row) and, within
a bucket, by order. A Feistel network on a grid of just over n cells permutes the numbers; walks
that leave 0 .. n-1 go on until they are back. Row number r of the permutation lies in shard
``r mod shards`` at slot ``r div shards``, so both can be computed for any row number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mesada.llm.common import checkpointed

PRIME = 2_147_483_647
ROUNDS = 6


def _round_keys(seed: int) -> list[tuple[int, int]]:
    """Two keys for each half round, from a linear congruential sequence."""
    keys, x = [], seed % PRIME
    for _ in range(2 * ROUNDS):
        pair = []
        for _ in range(2):
            x = (x * 48_271 + 11) % PRIME
            pair.append(x)
        keys.append((pair[0] | 1, pair[1]))
    return keys


def _scramble(half: Column, a: Column, b: Column) -> Column:
    """A fixed function of a number below 2^31; products stay below 2^62."""
    t = (half * a + b) % F.lit(PRIME)
    t = (t * t + half + a) % F.lit(PRIME)
    return (t * t + b) % F.lit(PRIME)


def grid(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid with at least n cells: under sqrt(n) + 1 too many."""
    rows = max(1, math.isqrt(max(0, n - 1)) + 1)
    return rows, max(1, -(-n // rows))


def feistel(x: Column, n: int, seed: int) -> Column:
    """The image of x, a number on the grid of n: one pass of the network.

    The halves swap after every half round; the rounds are a fold over their keys, so that
    each step's halves are computed once.
    """
    rows, cols = grid(n)
    keys = F.array(
        *[
            F.struct(
                F.lit(a).cast("long").alias("a"),
                F.lit(b).cast("long").alias("b"),
                F.lit((rows, cols)[k % 2]).cast("long").alias("side"),
            )
            for k, (a, b) in enumerate(_round_keys(seed))
        ]
    )
    start = F.struct(
        (x % F.lit(rows)).cast("long").alias("turn"),
        F.floor(x / F.lit(rows)).cast("long").alias("other"),
    )

    def half_round(held: Column, key: Column) -> Column:
        moved = held["turn"] + _scramble(held["other"], key["a"], key["b"])
        return F.struct(held["other"].alias("turn"), (moved % key["side"]).alias("other"))

    return F.aggregate(
        keys, start, half_round, lambda held: held["other"] * F.lit(rows) + held["turn"]
    )


def longest_walk(spark: SparkSession, n: int, seed: int) -> int:
    """The most further passes that any number needs to be back below n.

    Only the cells beyond n, fewer than sqrt(n) + 1 of them, can make a walk go on; all of them
    are walked until the last is back, so the bound is exact.
    """
    if n < 1:
        return 0
    rows, cols = grid(n)
    out, steps = checkpointed(spark.range(n, rows * cols).withColumnRenamed("id", "x")), 0
    while out.count():
        out = checkpointed(out.select(feistel(F.col("x"), n, seed).alias("x")).where(F.col("x") >= n))
        steps += 1
    return steps


def permuted(x: Column, n: int, seed: int, walk: int) -> Column:
    """The place in the shuffle of row number x below n; ``walk`` is longest_walk's bound."""
    return F.aggregate(
        F.array_repeat(F.lit(0), walk),
        feistel(x, n, seed),
        lambda at, _: F.when(at < n, at).otherwise(feistel(at, n, seed)),
    )


def numbered(rows: DataFrame, buckets: int = 8_192) -> tuple[DataFrame, int]:
    """rows with row_number, a global number from 0 that depends on content only, and the count.

    Equal rows are counted before the shuffle, so copies never meet as rows; they get
    consecutive numbers. A bucket's rows are sorted in one task: ``buckets`` bounds them to
    1 / ``buckets`` of the distinct rows, and the driver and the broadcast to ``buckets`` counts.
    """
    names = rows.columns
    alike = rows.groupBy(*names).agg(F.count("*").alias("copies"))
    alike = alike.withColumn("bucket", F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int"))
    per = alike.groupBy("bucket").agg(F.sum("copies").alias("held")).collect()
    first, n = [], 0
    for r in sorted(per, key=lambda r: r["bucket"]):
        first.append((r["bucket"], n))
        n += r["held"]
    starts = rows.sparkSession.createDataFrame(first, "bucket int, start long")
    before = W.partitionBy("bucket").orderBy(*[F.col(c).asc_nulls_first() for c in names])
    placed = (
        alike.join(F.broadcast(starts), "bucket")  # at most ``buckets`` rows
        .withColumn("upto", F.sum("copies").over(before.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("row_number", F.col("start") + F.col("upto") - F.col("copies"))
    )
    # A thousand copies at most from one array; the blocks of a row with more are dealt out.
    each = placed.withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / 1000).cast("int")))
    )
    each = each.withColumn(
        "copy",
        F.explode(
            F.sequence(
                F.col("block") * F.lit(1000).cast("long"),
                F.least(F.col("block") * F.lit(1000).cast("long") + 999, F.col("copies") - 1),
            )
        ),
    )
    return each.select(*names, (F.col("row_number") + F.col("copy")).alias("row_number")), n


def shard(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    seed: int = 2024,
    buckets: int = 8_192,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard): one row per row of docs.

    The law is ``rows``: counts of shards are at most one apart, slots run from 0 without gaps.
    ``grown_shard`` belongs to the law ``key`` and is null. A null text has 8 bytes and the
    CRC 0 of the empty text; null ids are ordinary; repeated rows get places of their own; an
    empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    held, n = numbered(rows, buckets)
    walk = longest_walk(docs.sparkSession, n, seed)
    placed = held.withColumn("place", permuted(F.col("row_number"), n, seed, walk))
    return placed.select(
        "id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
