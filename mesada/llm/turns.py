"""Conversations as numbered turns, and their rebuilding with another one's opening turns.

A conversation may be as long as a third of the table: rows are sorted over all partitions by
conversation and turn, a turn's number is its place in its partition's run of the conversation
plus the lengths of the runs before, and no step needs a conversation's rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mesada.llm.common import checkpointed

OPENING = 5


def numbered(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, pos, total, role, content, chars): turns by number from 1, and how many there are.

    Turns are ordered by turn, null first, ties by role and the MD5 of the text; ``content`` is
    that MD5, ``chars`` the text's code points. Null roles and texts are empty. Repeated rows
    are turns of their own. Rows without a conversation id belong to none and are left out.
    """
    spark = conversations.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = conversations.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.unhex(F.md5(text)).alias("content"),
        F.length(text).cast("long").alias("chars"),
    ).where("conv is not null")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("content")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = checkpointed(
        rows.select(
            F.spark_partition_id().alias("part"), row.alias("row"), "conv", "role", "content", "chars"
        )
    )
    runs = rows.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    by_conv = Window.partitionBy("conv")  # a row for each partition that holds some of it
    ahead = by_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "conv",
        "part",
        (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(by_conv).alias("total"),
    )
    return rows.join(runs, ["conv", "part"]).select(
        "conv", (F.col("row") + F.col("shift") + 1).alias("pos"), "total", "role", "content", "chars"
    )


def with_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, length) and turns (conv, d, length, role, content, chars), rebuilt.

    The first h turns of conversation c are replaced by the first h of c - c % 100 (all of
    them if there are fewer, none if there is no such conversation); h is the CRC of the
    decimal id by 6. A conversation with nothing left has length 0 and no turn.
    """
    turns = checkpointed(turns)
    heads = (
        turns.where((F.col("conv") % 100 == 0) & (F.col("pos") <= OPENING))
        .groupBy(F.col("conv").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "role", "content", "chars"))).alias("head"))
    )
    convs = turns.where("pos = 1").select(
        "conv",
        "total",
        (F.col("conv") - F.col("conv") % 100).alias("base"),
        (F.crc32(F.col("conv").cast("string")) % 6).cast("int").alias("h"),
    )
    convs = convs.join(heads, "base", "left")
    taken = F.least("h", F.coalesce(F.size("head"), F.lit(0)))
    taken = F.greatest(taken, F.lit(0)).cast("int")  # the size of a null array may be -1
    convs = convs.withColumn("taken", taken)
    length = F.col("taken") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    convs = checkpointed(
        convs.select(
            "conv", "h", "taken", length.alias("length"),
            F.slice("head", F.lit(1), F.col("taken")).alias("head"),
        )
    )
    columns = ["conv", "d", "length", "role", "content", "chars"]
    opening = convs.select("conv", "length", F.explode("head").alias("t"))
    opening = opening.select("conv", F.col("t.pos").alias("d"), "length", "t.role", "t.content", "t.chars")
    own = turns.join(convs.select("conv", "h", "taken", "length"), "conv").where("pos > h")
    own = own.withColumn("d", F.col("pos") - F.col("h") + F.col("taken"))
    return convs.select("conv", "length"), opening.unionByName(own.select(*columns))
