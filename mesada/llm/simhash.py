"""SimHash near-duplicates by tiled exact comparison of 64-bit fingerprints.

Fingerprints are made in the tasks that read the texts. The distinct ones are dealt into tiles
by population count; two fingerprints within ``radius`` bits have counts at most ``radius``
apart, so only tiles of such counts are joined. A pair of tiles is compared whole with numpy
exclusive-or and bit counts, and hands on a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mesada.llm.common import checkpointed, fresh, id_and_text, map_text
from mesada.llm.components import connected_components

SEED = 42
BLOCK = 65_536


def _bit_counts(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit, bit 0 first."""
    flat = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    bits = np.unpackbits(flat, axis=1, bitorder="little")
    whole = len(bits) // 255 * 255  # sums of 255 rows fit a byte
    if whole:
        total += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return total + bits[whole:].sum(0, dtype=np.int64)


def fingerprint(text: str, shingle: int = 4) -> int:
    """A bit is set if over half of the shingles' hashes have it; no words: 0."""
    words = text.encode().lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    ends = (ends[shingle - 1 :] - 1).tolist()
    digest, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), BLOCK):
        count += _bit_counts(
            [
                digest(joined[s:e], SEED)
                for s, e in zip(starts[k : k + BLOCK], ends[k : k + BLOCK], strict=True)
            ]
        )
    majority = np.packbits(2 * count > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(rows: DataFrame, shingle: int = 4) -> DataFrame:
    """rows with fp, the text's fingerprint as a signed long, in place of text."""

    def work(texts: pa.Array) -> list:
        made = np.fromiter(
            (fingerprint(t, shingle) for t in texts.to_pylist()), np.uint64, len(texts)
        )
        return [made.view(np.int64)]

    return map_text(rows, "text", work, "fp long", drop_text=True)


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a[i] and b[i]; labels holds each node's root, roots hold themselves."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            return
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def _half_counts(fps: np.ndarray) -> np.ndarray:
    """Bits set in the lower half."""
    return np.bitwise_count(fps & np.uint64(0xFFFFFFFF)).astype(np.int64)


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple:
    """A spanning forest, as two arrays of ends, of the links of a tile with itself or another.

    Rows are ordered by the bits set in their lower half. If d is how many more bits a has than
    b, then a and b can only be linked if a's lower half has between (d - radius) / 2 and
    (d + radius) / 2 more than b's: the halves' differences add up to the radius at most. So
    each run of rows meets one stretch of the other tile.
    """
    left = left[np.argsort(_half_counts(left), kind="stable")]
    if right is None:
        nodes, other, shift = left, left, 0
    else:
        other = right[np.argsort(_half_counts(right), kind="stable")]
        nodes, shift = np.concatenate([left, other]), len(left)
    labels = np.arange(len(nodes))
    if not len(left) or not len(other):
        return nodes[:0], nodes[:0]
    mine, theirs = _half_counts(left), _half_counts(other)
    bits, more = (np.bitwise_count(x).astype(np.int64) for x in (left, other))
    least, most = int(bits.min() - more.max()), int(bits.max() - more.min())
    k = 0
    while k < len(left):
        group = int(np.searchsorted(mine, mine[k], "right"))
        first = int(np.searchsorted(theirs, mine[k] - (most + radius) // 2, "left"))
        last = int(np.searchsorted(theirs, mine[k] + (radius - least) // 2, "right"))
        if right is None:
            first = max(first, k)
        rows = max(1, (1 << 21) // max(1, last - first))
        end = min(group, k + rows)
        near = np.bitwise_count(left[k:end, None] ^ other[None, first:last]) <= radius
        a, b = np.nonzero(near)
        a, b = a + k, b + first
        if right is None:
            a, b = a[a < b], b[a < b]
        _merge(labels, a, b + shift)
        k = end
    linked = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[linked], nodes[labels[linked]]


def fingerprint_links(fps: DataFrame, radius: int = 4, tile: int = 16_384) -> DataFrame:
    """(fp) distinct longs -> (u, v): links that connect whatever is within ``radius`` bits.

    ``tile`` bounds the fingerprints of a tile (in the mean: they are dealt by hash). The driver
    sees 65 counts only. Work grows with the square of the number of distinct fingerprints, cut
    to tiles of near population counts; memory of a task does not grow.
    """
    fps = fps.select("fp", F.bit_count("fp").alias("p"))
    sizes = {r["p"]: r["n"] for r in fps.groupBy("p").agg(F.count("*").alias("n")).collect()}
    tiles = [-(-sizes.get(p, 0) // tile) for p in range(65)]
    many = F.array(*[F.lit(n) for n in tiles])
    packed = checkpointed(
        fps.withColumn("i", F.pmod(F.xxhash64("fp"), F.element_at(many, F.col("p") + 1)))
        .groupBy("p", "i")
        .agg(F.collect_list("fp").alias("fps"))
    )
    # Tile (p, i) meets (q, j) of the same or a larger count; among the same count, j >= i.
    left = (
        packed.withColumn(
            "q", F.explode(F.sequence("p", F.least(F.col("p") + radius, F.lit(64))))
        )
        .withColumn("nq", F.element_at(many, F.col("q") + 1))
        .withColumn("from", F.when(F.col("q") == F.col("p"), F.col("i")).otherwise(F.lit(0)))
        .where("nq > from")
        .withColumn("j", F.explode(F.sequence(F.col("from"), F.col("nq").cast("long") - 1)))
        .select("p", "i", "q", "j", F.col("fps").alias("left"))
    )
    right = packed.select(F.col("p").alias("q"), F.col("i").alias("j"), F.col("fps").alias("right"))
    conf = fps.sparkSession.conf
    tasks = max(int(conf.get("spark.sql.shuffle.partitions")), min(sum(tiles), 20_000))
    # The numbers of partitions are given: adaptive merging by bytes would leave few tasks.
    pairs = (
        left.repartition(tasks, "q", "j")
        .join(right.repartition(tasks, "q", "j"), ["q", "j"])
        .select(((F.col("p") == F.col("q")) & (F.col("i") == F.col("j"))).alias("same"),
                "left", "right")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = (
                    batch.column(c)[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    for c in (1, 2)
                )
                u, v = tile_links(a, None if batch.column(0)[k].as_py() else b, radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
                )

    return pairs.mapInArrow(compare, "u long, v long")


def _classes(rows: DataFrame, shingle: int, radius: int, tile: int) -> DataFrame:
    """rows (id, text and others) with fp, label and component_id in place of text."""
    prints = checkpointed(fingerprints(rows, shingle))
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least_id"))
    labels = connected_components(fingerprint_links(distinct.select("fp"), radius, tile))
    classes = checkpointed(
        distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "least_id", F.coalesce("label", "fp").alias("label")
        )
    )
    # Written, so that both sides of the join by label are shuffled and Spark can split a
    # class of very many fingerprints.
    least = checkpointed(classes.groupBy("label").agg(F.min("least_id").alias("component_id")))
    named = classes.select("fp", "label").join(least, "label")
    return prints.join(named, "fp")


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
    tile: int = 16_384,
) -> DataFrame:
    """(id, fp, label, component_id): one row per row of docs.

    ``label`` names the class of fingerprints; ``component_id`` is its least id. Null texts are
    empty, texts without words have fingerprint 0 and link like any other, null ids count as
    rows and never as a component's least id (a class of null ids only has a null one).
    Repeated rows share everything; an empty table gives an empty result.
    """
    rows = id_and_text(docs, id_col, text_col)
    return _classes(rows, shingle, radius, tile).select("id", "fp", "label", "component_id")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
    tile: int = 16_384,
) -> DataFrame:
    """One row of docs for each class of simhash_components: the one with the least id.

    Among rows of a class with that same id (null if the class has null ids only) the one of the
    least text hash stays, and of repeated rows one.
    """
    ident, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    content = F.xxhash64(ident.isNull(), ident, text)
    rows = docs.select(ident.alias("id"), text.alias("text"), content.alias("content"))
    linked = _classes(rows, shingle, radius, tile)
    kept = (
        linked.where(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("label")
        .agg(F.min(F.struct("content", "id")).alias("first"))
        .select("first.content", F.col("first.id").alias("kept_id"))
    )
    names = fresh(docs, "content", "kept_id", "copy")
    kept = kept.toDF(*names[:2])
    held = docs.withColumn(names[0], content).join(kept, names[0])
    held = held.where(ident.eqNullSafe(F.col(names[1])))
    copies = W.partitionBy(names[0]).orderBy(F.lit(0))  # the join's own partitioning
    return held.withColumn(names[2], F.row_number().over(copies)).where(
        F.col(names[2]) == 1
    ).select(*[f"`{c}`" for c in docs.columns])
