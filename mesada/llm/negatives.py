"""Hard negatives by exact inner products, found with angular triangle filtering.

Components become integers, so scores are exact. Every row is stored with its norm and its
angles to a few reference directions. The angle between an anchor and a row lies between the
difference and the sum of their angles to each direction (the triangle inequality of angles);
its cosine interval, times the norms, bounds their score. Bounds are widened by more than the
rounding of the stored angles can change. Rows are stored in groups, sorted by their nearest
direction and the angle to it, and cut into tiles whose intervals of angles and norms bound
all their rows at once. A search asks for the best rows of windows of scores: tiles and then
rows whose interval misses every window are passed over, and only the others get an integer
score. Windows shrink from below as good rows are found.

Anchors are copied to every group and answered there one after the other, so a task holds one
group of bounded size; the best rows of all groups meet in a window by anchor. An anchor has
few rows in it, and a hot vector or label is spread over the groups, ties being ordered by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesada.llm.common import checkpointed

#: Bounded sample from which the reference directions are chosen.
SAMPLE = 1_024
DIRECTIONS = 8
TILE = 128
FIRST_TILES = 4
#: Bytes of a group's components as 8-byte numbers.
GROUP_BYTES = 64 << 20
#: Radians by which stored angles may be off together: two float32 roundings and two arc cosines.
SLACK = 2e-6
LONG = (1 << 63) - 1


def matrix(vectors: pa.Array, scale: float) -> np.ndarray:
    """Rows of floor(scale * x) as float64, short ones filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    width = int(sizes.max(initial=0))
    if len(sizes) * width == len(flat):
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products; missing components are zeros, and values past a long are its limit."""
    width = min(rows.shape[1], len(vector))
    rows, vector = rows[:, :width], vector[:width]
    most = np.abs(rows).max(initial=0) * np.abs(vector).max(initial=0) * max(width, 1)
    if most < 1 << 53:
        return (rows @ vector).astype(np.int64)  # every partial sum is a whole float64
    right = [int(x) for x in vector]
    made = [sum(int(x) * y for x, y in zip(row, right, strict=True)) for row in rows]
    return np.array([max(-LONG, min(LONG, s)) for s in made], np.int64)


def angles_to(rows: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of rows to unit directions; a zero row is at a right angle to all."""
    width = min(rows.shape[1], directions.shape[1])
    cosines = rows[:, :width] @ directions[:, :width].T
    return np.arccos(np.clip(cosines / np.where(norms > 0, norms, 1.0)[:, None], -1, 1))


def choose_directions(rows: np.ndarray, many: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors far from each other among the rows, each the farthest from those before."""
    norms = np.sqrt((rows**2).sum(axis=1))
    rows = rows[norms > 0] / norms[norms > 0][:, None]
    if not len(rows):
        return np.zeros((0, rows.shape[1]))
    chosen = [0]
    near = rows @ rows[0]
    while len(chosen) < many:
        far = int(near.argmin())
        if near[far] > 1 - 1e-9:
            break
        chosen.append(far)
        near = np.maximum(near, rows @ rows[far])
    return rows[chosen]


def score_bounds(anchor, norm, least, most, norm_least, norm_most):
    """(low, high) of the scores of rows whose angles and norms lie in the given intervals."""
    gap = np.maximum(np.maximum(anchor - most, least - anchor) - SLACK, 0.0)
    high = np.cos(np.minimum(gap, np.pi)).min(axis=1, initial=1.0)
    start, end = anchor + least - SLACK, anchor + most + SLACK
    low = np.minimum(np.cos(start), np.cos(end))
    low = np.where((start <= np.pi) & (end >= np.pi), -1.0, low).max(axis=1, initial=-1.0)
    width = norm * norm_most * 1e-9 + 1.0
    high = norm * high * np.where(high >= 0, norm_most, norm_least) + width
    return norm * low * np.where(low >= 0, norm_least, norm_most) - width, high


@dataclass
class Best:
    """The best rows of one window so far: scores, their rows, and what a row must reach."""

    low: int
    high: int
    scores: np.ndarray
    rows: np.ndarray

    def offer(self, scores: np.ndarray, rows: np.ndarray, place: np.ndarray, top: int) -> None:
        fit = (scores >= self.low) & (scores <= self.high)
        scores = np.concatenate([self.scores, scores[fit]])
        rows = np.concatenate([self.rows, rows[fit]])
        order = np.lexsort((place[rows], -scores))[:top]
        self.scores, self.rows = scores[order], rows[order]
        if len(order) == top:
            self.low = max(self.low, int(self.scores[-1]))


class Group:
    """Rows of one group with their stored angles, in tiles."""

    def __init__(self, table: pa.Table, scale: float):
        self.vectors = matrix(table["v"].combine_chunks(), scale)
        norms = table["norm"].to_numpy()
        packed = table["angles"].to_pylist()
        angles = np.array([np.frombuffer(b, np.float32) for b in packed]).astype(np.float64)
        angles = angles.reshape(len(packed), -1)
        if angles.shape[1]:
            cell = angles.argmin(axis=1)
            order = np.lexsort((angles[np.arange(len(cell)), cell], cell))
        else:
            order = np.arange(len(packed))
        self.vectors, self.norms, self.angles = self.vectors[order], norms[order], angles[order]
        self.ids = table["id"].combine_chunks().take(pa.array(order))
        self.place = np.empty(len(order), np.int64)  # by id, nulls last
        self.place[pc.sort_indices(self.ids, null_placement="at_end").to_numpy()] = np.arange(
            len(order)
        )
        labels = table["label"].combine_chunks().take(pa.array(order)).dictionary_encode()
        self.codes = labels.indices.to_numpy()
        self.code_of = {v: k for k, v in enumerate(labels.dictionary.to_pylist())}
        self.starts = np.arange(0, len(order), TILE)
        ends = np.append(self.starts[1:], len(order))
        self.tiles = list(zip(self.starts.tolist(), ends.tolist(), strict=True))
        if len(order):
            self.least = np.minimum.reduceat(self.angles, self.starts, axis=0)
            self.most = np.maximum.reduceat(self.angles, self.starts, axis=0)
            self.norm_least = np.minimum.reduceat(self.norms, self.starts)
            self.norm_most = np.maximum.reduceat(self.norms, self.starts)
        self.scored = 0

    def search(self, vector, norm, angles, allowed, windows, top: int) -> list[Best]:
        """For each window (low, high) the ``top`` allowed rows in it, by score, then id."""
        none = np.zeros(0, np.int64)
        best = [Best(low, high, none, none) for low, high in windows]
        if not len(self.starts):
            return best
        low, high = score_bounds(
            angles, norm, self.least, self.most, self.norm_least, self.norm_most
        )
        order = np.argsort(-high, kind="stable")

        def meets(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            met = np.zeros(len(low), bool)
            for b in best:
                met |= (high >= b.low) & (low <= b.high)
            return met

        order = order[meets(low, high)[order]]
        for first, last in ((0, FIRST_TILES), (FIRST_TILES, len(order))):
            tiles = order[first:last]
            tiles = tiles[meets(low[tiles], high[tiles])]
            if not len(tiles):
                continue
            rows = np.concatenate([np.arange(*self.tiles[k]) for k in tiles])
            rows = rows[allowed[rows]]
            own = self.angles[rows]
            rows = rows[meets(*score_bounds(angles, norm, own, own, *[self.norms[rows]] * 2))]
            scores = products(self.vectors[rows], vector)
            self.scored += len(rows)
            for b in best:
                b.offer(scores, rows, self.place, top)
        return best


def _valid(vector: str) -> Column:
    return F.col("label").isNotNull() & F.col(vector).isNotNull() & F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )


def _stored(rows: DataFrame, scale: float) -> tuple[DataFrame, int]:
    """Rows (id, label, v, anchor) with norm, angles and group, in the shared folder; groups."""
    spark = rows.sparkSession
    shape = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not shape[0]:
        return rows, 0
    sample = rows.select("v").orderBy(F.xxhash64("id", "v")).limit(SAMPLE).collect()
    kind = pa.list_(pa.float64())
    directions = choose_directions(matrix(pa.array([list(r[0]) for r in sample], kind), scale))
    shipped = spark.sparkContext.broadcast(directions)  # DIRECTIONS rows

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = matrix(batch.column(batch.schema.get_field_index("v")), scale)
            norms = np.sqrt((made**2).sum(axis=1))
            angles = angles_to(made, norms, shipped.value).astype(np.float32)
            if angles.shape[1]:
                cell, near = angles.argmin(axis=1), angles.min(axis=1)
            else:
                cell, near = np.zeros(len(made), int), np.zeros(len(made))
            new = [
                pa.array(norms),
                pa.array([a.tobytes() for a in angles], pa.binary()),
                pa.array(cell, pa.int32()),
                pa.array(near, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *new], names=[*batch.schema.names, "norm", "angles", "cell", "near"]
            )

    kinds = dict(rows.dtypes)
    fields = ", ".join(f"{n} {kinds[n]}" for n in rows.columns)
    measured = rows.mapInArrow(
        measure, f"{fields}, norm double, angles binary, cell int, near double"
    )
    wide = shape[0] * max(1, shape[1]) * 8 // GROUP_BYTES + 1
    many = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wide)
    spread = F.xxhash64("id", "label")
    grouped = measured.repartitionByRange(many, "cell", "near", "id", spread)
    stored = checkpointed(grouped.drop("cell", "near").withColumn("g", F.spark_partition_id()))
    return stored, stored.agg(F.max("g")).first()[0] + 1


def _searched(
    stored: DataFrame, anchors: DataFrame, groups: int, scale: float, work, fields: str
) -> DataFrame:
    """What ``work(group, anchor)`` returns for every group and anchor: lists of Arrow rows."""
    columns = ["id", "label", "v", "norm", "angles", "a", "asked"]
    rows = stored.select(
        "g", *columns[:-2], F.lit(None).cast("long").alias("a"),
        F.lit(None).cast("array<long>").alias("asked"),
    )
    copies = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), *columns)
    met = rows.unionByName(copies).repartitionById(groups, "g")
    met = met.sortWithinPartitions(F.col("a").asc_nulls_first())
    names = [part.split()[0] for part in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], None
        for batch in batches:
            own = batch.filter(pc.is_null(batch["a"]))
            asking = batch.filter(pc.is_valid(batch["a"]))
            if own.num_rows:
                held.append(own)
            if not asking.num_rows or not held:
                continue
            if group is None:
                group = Group(pa.Table.from_batches(held), scale)
            vectors = matrix(asking["v"], scale)
            made = []
            for k, row in enumerate(asking.drop_columns(["v", "g"]).to_pylist()):
                angles = np.frombuffer(row["angles"], np.float32).astype(np.float64)
                made += work(group, row, vectors[k], angles)
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(column) for column in zip(*made, strict=True)], names=names
                )

    return met.mapInArrow(run, fields)


def hard_negatives(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    anchor: Column | None = None,
    scale: float = 256.0,
    n_positives: int = 5,
    n_negatives: int = 10,
    least: int = 30,
    most: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Each component becomes floor(scale * x); a score is the inner product of these. Anchors are
    the rows for which ``anchor`` holds (default: ids divisible by 100). An anchor's positives
    are its best ``n_positives`` rows of its label and another id; for each, the best
    ``n_negatives`` rows of another label with least * positive <= 100 * negative <= most *
    positive are returned. Higher scores come first, ties by smaller id, null ids last.

    Rows with a null label or vector or a null or non-finite component take no part. Repeated
    rows count each, as rows and as anchors; those with the anchor's own id are never its
    positives. A null id is no anchor by default. Vectors of different lengths are filled up
    with zeros, so an empty one scores 0. Scores beyond a long count as its limit. An empty
    table gives an empty result.
    """
    spark = rows.sparkSession
    ident = F.col(f"`{id_col}`")
    anchor = ident % 100 == 0 if anchor is None else anchor
    rows = rows.select(
        ident.alias("id"),
        F.col(f"`{vec_col}`").alias("v"),
        F.col(f"`{label_col}`").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where(_valid("v"))
    kind = dict(rows.dtypes)["id"]
    stored, groups = _stored(rows, scale)
    result = (
        f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, "
        "positive_score long, negative_score long"
    )
    if not groups:
        return spark.createDataFrame([], result)
    anchors = stored.where("anchor").withColumn("a", F.monotonically_increasing_id())

    def taken(group, best, a, number):
        n = len(best.rows)
        return (
            pa.array(np.full(n, a, np.int64)),
            pa.array(np.full(n, number, np.int32)),
            pa.array(best.scores),
            group.ids.take(pa.array(best.rows)),
        )

    def same_label(group, row, vector, angles):
        allowed = group.codes == group.code_of.get(row["label"], -1)
        other = pc.fill_null(pc.not_equal(group.ids, pa.scalar(row["id"], group.ids.type)), True)
        allowed &= other.to_numpy(zero_copy_only=False)
        found = group.search(
            vector, row["norm"], angles, allowed, [(-LONG, LONG)], n_positives
        )
        return [taken(group, b, row["a"], 0) for b in found if len(b.rows)]

    def other_label(group, row, vector, angles):
        allowed = group.codes != group.code_of.get(row["label"], -1)
        windows = [(-(-least * p // 100), most * p // 100) for p in row["asked"]]
        found = group.search(vector, row["norm"], angles, allowed, windows, n_negatives)
        return [taken(group, b, row["a"], j) for j, b in enumerate(found) if len(b.rows)]

    fields = f"a long, j int, score long, id {kind}"
    order = [F.desc("score"), F.col("id").asc_nulls_last()]
    asked = anchors.withColumn("asked", F.lit(None).cast("array<long>"))
    near = _searched(stored, asked, groups, scale, same_label, fields)
    near = near.withColumn("k", F.row_number().over(Window.partitionBy("a").orderBy(*order)))
    near = near.where(F.col("k") <= n_positives)
    positives = checkpointed(
        near.groupBy("a")
        .agg(F.array_sort(F.collect_list(F.struct("k", "id", "score"))).alias("found"))
        .join(anchors, "a")
        .select("a", "id", "label", "v", "norm", "angles", "found")
    )
    asked = positives.withColumn("asked", F.col("found.score"))
    made = _searched(stored, asked, groups, scale, other_label, fields)
    made = made.withColumn("rank", F.row_number().over(Window.partitionBy("a", "j").orderBy(*order)))
    made = made.where(F.col("rank") <= n_negatives)
    heads = positives.select("a", F.col("id").alias("anchor_id"), F.posexplode("found"))
    heads = heads.select("a", F.col("pos").alias("j"), "anchor_id", "col")
    return made.join(heads, ["a", "j"]).select(
        "anchor_id",
        F.col("col.id").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("col.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
