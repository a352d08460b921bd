"""The prefix trie of conversations, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns; its key is the exclusive-or of two 64-bit hashes
of each turn with its depth, which a window over a block of LEVELS turns and the totals of the
blocks before it make, so a long conversation is spread over blocks.

A node shared by more than 1/HEAVY of all turns is heavy; there are fewer than HEAVY of them.
Below them the trie falls into subtrees of light nodes, which are cut again at every LEVELS
levels. These pieces are dealt to shards. A shard's nodes are sorted, deepest level first, by
Spark's external sort; every node takes the totals that its children have sent, adds its own,
and sends the sum forward to its parent through a priority queue ordered like the nodes, which
spills. Piece roots end a shard's work. Heavy nodes, and pieces that others hang on, are then
processed the same way with the roots' totals; pieces that others hang on are run once more,
with those totals sent to their nodes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mesada.llm.common import checkpointed, shared_dir
from mesada.llm.spill import SpillingQueue

LEVELS = 4_096
HEAVY = 65_536
QUEUE = 1 << 17
CHUNK = 1 << 13
TOTALS = "n_leaves long, saved_tokens long, n_children long"
KEY = ["k1", "k2"]


def node_rows(turns: DataFrame, levels: int) -> DataFrame:
    """(conv, d, block, length, chars, k1, k2, p1, p2): the node of every turn and its parent."""
    block = F.floor((F.col("d") - 1) / F.lit(levels))
    turns = turns.withColumn("block", block)
    for k in (1, 2):
        turns = turns.withColumn(f"e{k}", F.xxhash64(F.lit(k), "role", "content", "d"))
    turns = turns.select("conv", "d", "block", "length", "chars", "e1", "e2")
    whole = (
        turns.where(F.col("length") > levels)
        .groupBy("conv", "block")
        .agg(F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"))
    )
    ahead = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = whole.select("conv", "block", *[F.bit_xor(f"x{k}").over(ahead).alias(f"a{k}") for k in (1, 2)])
    # Rows of a conversation are met by block, so a long one does not go to one task.
    turns = turns.join(ahead, ["conv", "block"], "left")
    so_far = (
        Window.partitionBy("conv", "block")
        .orderBy("d")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    for k in (1, 2):
        turns = turns.withColumn(
            f"k{k}",
            F.bit_xor(f"e{k}").over(so_far).bitwiseXOR(F.coalesce(f"a{k}", F.lit(0))),
        )
    parents = [F.col(f"k{k}").bitwiseXOR(F.col(f"e{k}")).alias(f"p{k}") for k in (1, 2)]
    return turns.select("conv", "d", "block", "length", "chars", *KEY, *parents)


def forward(rows: DataFrame, folder: str, limit: int) -> DataFrame:
    """The nodes among rows with their subtree totals; rows of a partition in reverse level order.

    Nodes have key (d, k1, k2), their parent's (pd, p1, p2), their own ``leaf`` and ``saved``;
    ``sends`` says whether they send to a parent in the same partition. Rows with ``leaf``
    null are totals sent from elsewhere: (n_leaves, saved, n_children) to the node of their key.
    """
    columns = [f for f in rows.schema.fields if f.name not in ("leaves", "children")]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    rows = rows.sortWithinPartitions(F.desc("d"), *KEY, F.col("leaf").asc_nulls_first())
    needed = ["d", "k1", "k2", "pd", "p1", "p2", "leaf", "saved", "sends", "leaves", "children"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(folder, limit)
        key, sent = None, [0, 0, 0]
        try:
            for batch in batches:
                place, leaves, saved, children = [], [], [], []
                values = zip(*(batch[n].to_pylist() for n in needed), strict=True)
                for at, (d, k1, k2, pd, p1, p2, leaf, own, sends, more, many) in enumerate(values):
                    if key != (d, k1, k2):
                        key, sent = (d, k1, k2), [0, 0, 0]
                    if leaf is None:
                        sent = [sent[0] + more, sent[1] + own, sent[2] + many]
                        continue
                    low, tokens, below = sent
                    head = queue.least()
                    while head is not None and head[:3] == (-d, k1, k2):
                        _, _, _, a, b = queue.pop()
                        low, tokens, below = low + a, tokens + b, below + 1
                        head = queue.least()
                    low, tokens = low + leaf, tokens + own
                    if sends:
                        queue.push((-pd, p1, p2, low, tokens))
                    place.append(at)
                    leaves.append(low)
                    saved.append(tokens)
                    children.append(below)
                if place:
                    kept = batch.take(pa.array(place)).select([f.name for f in columns])
                    totals = [pa.array(v, pa.int64()) for v in (leaves, saved, children)]
                    yield pa.RecordBatch.from_arrays(
                        [*kept.columns, *totals],
                        names=[*kept.schema.names, "n_leaves", "saved_tokens", "n_children"],
                    )
        finally:
            queue.close()

    return rows.mapInArrow(run, f"{ddl}, {TOTALS}")


def _summed(roots: DataFrame, d: str, k1: str, k2: str, *more: str) -> DataFrame:
    """Totals of piece roots by the node that they are sent to, as rows for ``forward``."""
    key = [F.col(n).alias(m) for n, m in ((d, "d"), (k1, "k1"), (k2, "k2"))]
    return roots.groupBy(*key, *more).agg(
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"),
        F.sum(F.lit(1)).alias("children"),
    )


def _ends(rows: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of nodes that are some conversation's last.

    Ids are sorted over all partitions and joined in chunks of text; a node's chunks are
    hashed one after the other, so that a node of very many ids is a few rows of one task.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(*KEY, "conv", F.col("conv").cast("string").alias("name"))
    order = [*KEY, "conv"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = rows.select(*KEY, "name", F.spark_partition_id().alias("part"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, size, number = None, [], 0, 0
        names_out = [*KEY, "part", "number", "chunk"]

        def made(part):
            values = ((key[0],), (key[1],), (part,), (number,), (",".join(names),))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())
            return [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]

        part = None
        out: list[list] = []
        for batch in batches:
            for a, b, name, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key is not None and ((a, b) != key or size > CHUNK):
                    out.append(made(part))
                    names, size, number = [], 0, number + 1
                key = (a, b)
                names.append(name)
                size += len(name) + 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(c) for c in zip(*out, strict=True)], names=names_out
                )
                out = []
        if key is not None:
            yield pa.RecordBatch.from_arrays(made(part), names=names_out)

    kinds = "k1 long, k2 long, part int, number long, chunk string"
    parted = rows.mapInArrow(chunks, kinds).repartition(parts, *KEY)
    parted = parted.sortWithinPartitions(*KEY, "part", "number")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for a, b, _, _, chunk in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key == (a, b):
                    state.update(b"," + chunk.encode())
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256(chunk.encode())
            if done:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip((*KEY, "ends_sha256"), r, strict=True)) for r in done]
                )
        if key is not None:
            row = dict(zip((*KEY, "ends_sha256"), (*key, state.hexdigest()), strict=True))
            yield pa.RecordBatch.from_pylist([row])

    return parted.mapInArrow(digests, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(
    convs: DataFrame,
    turns: DataFrame,
    levels: int = LEVELS,
    heavy_share: int = HEAVY,
    limit: int = QUEUE,
) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256).

    ``convs`` has (conv, length), each conversation once; ``turns`` has (conv, d, length, role,
    content, chars) for d from 1 to length. Conversations without a turn are members of the
    root alone. An empty table gives no node, the root included.
    """
    spark = convs.sparkSession
    rows = checkpointed(node_rows(turns, levels))
    count, longest = rows.agg(F.count("*"), F.max("length")).first()
    folder = f"{shared_dir(spark)}/queue-{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    leaf = (F.col("n_ends") == F.col("n_convs")).cast("long")
    nodes = rows.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"),
        F.min("d").alias("d"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.min("chars").alias("chars"),
        F.count("*").alias("n_convs"),
        F.count_if(F.col("d") == F.col("length")).alias("n_ends"),
    )
    root = convs.agg(
        F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.count_if(F.col("length") == 0).alias("n_ends"),
    ).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(
        *[zero.alias(k) for k in KEY], "conv_id", zero.alias("d"), zero.alias("p1"),
        zero.alias("p2"), zero.alias("chars"), "n_convs", "n_ends",
    )
    nodes = nodes.unionByName(root).select(
        *KEY, "conv_id", "d", "p1", "p2", "n_convs", leaf.alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        ((F.col("n_convs") > max(1, count // heavy_share)) | (F.col("d") == 0)).alias("heavy"),
        (F.col("d") - 1).alias("pd"),
    )
    nodes = checkpointed(nodes)
    # Fewer than heavy_share rows and the root: their counts sum up to at most all turns.
    heavy = nodes.where("heavy")
    marks = F.broadcast(heavy.select(F.col("k1").alias("h1"), F.col("k2").alias("h2"), F.col("conv_id").alias("heavy_conv")))

    # The root of a light node's piece is the first light node of its conversation's block.
    starts = (
        rows.join(marks, (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")), "left_anti")
        .groupBy(F.col("conv").alias("conv_id"), "block")
        .agg(F.min(F.struct("d", *KEY)).alias("start"))
    )
    block = F.floor((F.col("d") - 1) / F.lit(levels))
    light = nodes.where("not heavy").withColumn("block", block)
    light = light.join(starts, ["conv_id", "block"]).select(
        *KEY, "conv_id", "d", "p1", "p2", "pd", "n_convs", "leaf", "saved", "block",
        F.col("start.k1").alias("f1"), F.col("start.k2").alias("f2"), F.col("start.d").alias("fd"),
    )
    light = light.withColumn("sends", F.col("d") > F.col("fd"))
    nothing = [F.lit(None).cast("long").alias(n) for n in ("leaves", "children")]

    def within(rows: DataFrame) -> DataFrame:
        return checkpointed(forward(rows.repartition(parts, "f1", "f2"), folder, limit))

    local = within(light.select("*", *nothing))
    tops = local.where("not sends").join(
        marks, (F.col("p1") == F.col("h1")) & (F.col("p2") == F.col("h2")), "left"
    )
    # Totals of the pieces below heavy nodes: a row for each heavy node at most.
    sent = _summed(tops.where("heavy_conv is not null"), "pd", "p1", "p2")
    plain = ["d", *KEY, "pd", "p1", "p2", "leaf", "saved", "sends", "leaves", "children"]
    above = heavy.select("d", *KEY, "pd", "p1", "p2", "leaf", "saved", (F.col("d") > 0).alias("sends"), *nothing)
    if longest is not None and longest > levels:
        # Pieces that hang on the last level of another piece, and the piece they hang on.
        hung = tops.where("heavy_conv is null").drop("h1", "h2", "heavy_conv")
        onto = starts.select(
            "conv_id", (F.col("block") + 1).alias("block"), F.col("start.d").alias("ud"),
            F.col("start.k1").alias("u1"), F.col("start.k2").alias("u2"),
        )
        hung = checkpointed(hung.join(onto, ["conv_id", "block"]))
        holders = hung.select(F.col("u1").alias("f1"), F.col("u2").alias("f2")).distinct()
        held = tops.join(holders, ["f1", "f2"], "left_semi")
        held = held.join(hung.select(*KEY, "ud", "u1", "u2"), KEY, "left")
        # A piece counts as one node with its local totals, below the piece or node it hangs on.
        up = [F.coalesce(a, b).alias(b) for a, b in (("ud", "pd"), ("u1", "p1"), ("u2", "p2"))]
        as_nodes = held.select(
            "d", *KEY, *up, F.col("n_leaves").alias("leaf"), F.col("saved_tokens").alias("saved"),
            F.lit(True).alias("sends"), *nothing,
        )
        last = hung.join(holders.select(F.col("f1").alias("k1"), F.col("f2").alias("k2")), KEY, "left_anti")
        loose = _summed(last, "ud", "u1", "u2")
        # Those below heavy nodes send as nodes now.
        below = tops.where("heavy_conv is not null").join(holders, ["f1", "f2"], "left_anti")
        sent = _summed(below, "pd", "p1", "p2")
        above, sent = above.unionByName(as_nodes), sent.unionByName(loose)
    none = [F.lit(None).cast("long").alias(n) for n in ("pd", "p1", "p2", "leaf")]
    sent = sent.select("d", *KEY, *none, "saved", F.lit(False).alias("sends"), "leaves", "children")
    across = above.select(*plain).unionByName(sent.select(*plain)).repartition(1)
    across = checkpointed(forward(across, folder, limit))
    totals = [*KEY, "n_leaves", "saved_tokens", "n_children"]
    top = heavy.join(across.select(*totals), KEY)
    columns = ["conv_id", "d", "p1", "p2", "n_convs", *totals]
    made = local
    if longest is not None and longest > levels:
        known = across.select(*KEY, F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("s"))
        sums = hung.join(known, KEY, "left").select(
            "pd", "p1", "p2", F.col("u1").alias("f1"), F.col("u2").alias("f2"),
            F.coalesce("l", "n_leaves").alias("n_leaves"),
            F.coalesce("s", "saved_tokens").alias("saved_tokens"),
        )
        sums = _summed(sums, "pd", "p1", "p2", "f1", "f2")
        again = light.select("*", *nothing).join(holders, ["f1", "f2"], "left_semi")
        again = within(again.unionByName(sums, allowMissingColumns=True))
        made = local.join(holders, ["f1", "f2"], "left_anti").select(*columns).unionByName(
            again.select(*columns)
        )
    # Parents: heavy ones by broadcast, as they may have very many children, others by a join.
    made = made.select(*columns).unionByName(top.select(*columns)).join(
        marks, (F.col("p1") == F.col("h1")) & (F.col("p2") == F.col("h2")), "left"
    )
    near = made.where("heavy_conv is not null").withColumn("parent", F.col("heavy_conv"))
    parent = nodes.where("not heavy").select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent")
    )
    far = made.where("heavy_conv is null").join(parent, ["p1", "p2"])
    ends = _ends(
        rows.where("d = length").select(*KEY, "conv").unionByName(
            convs.where("length = 0").select(*[zero.alias(k) for k in KEY], "conv")
        )
    )
    none = hashlib.sha256(b"").hexdigest()
    out = checkpointed(
        near.unionByName(far).join(ends, KEY, "left").select(
            "conv_id",
            F.col("d").alias("depth"),
            F.when(F.col("d") > 0, F.col("parent")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )
    files, root_folder = fs.FileSystem.from_uri(folder)
    if files.get_file_info(root_folder).type != fs.FileType.NotFound:
        files.delete_dir(root_folder)  # runs of tasks that were lost
    return out

