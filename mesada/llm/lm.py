"""Scoring with a word-pair language model kept in Elias-Fano tries, one for each shard of words.

The model is a Dirichlet-smoothed pair model: P(w | v) = (c(v w) + mu P(w)) / (c(v) + mu), with
P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)); a text starts after an end. The log of a text's
probability is a sum over its tokens of ``log(c(v w) + mu P(w)) - log(c(w) + mu)``: each token
is predicted once and is a context once (the end stands for the start). Both terms need only
the counts of w and of the pair, so words are dealt to shards by hash, and a shard counts,
builds its trie and scores by itself. A text goes to the shards as its distinct pairs by block
of texts, packed; sums come back by block.

Words with more than 1 / HEAVY of all training tokens, at most HEAVY of them, are broadcast with
their counts, and their pairs are dealt by both words, so no shard holds a frequent word whole.
Words are 64-bit hashes; the context of a pair is known by 48 bits within its word.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesada.llm.common import checkpointed, id_and_text, shared_dir
from mesada.llm.trie import PairTrie
from mesada.llm.words import U, mix, words_of

HEAVY = 1_024
BLOCK_BYTES = 5 << 20
END = U(0x5EED0E0D5EED0E0D)
CONTEXT = U((1 << 48) - 1)


def held_out(ident: Column) -> Column:
    """Remainder 1 of the id's CRC by 5; a null id is a training text."""
    return F.coalesce(F.crc32(ident.cast("string")) % 5 == 1, F.lit(False))


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> U(32)) * U(shards) >> U(32)).astype(np.int32)


def _groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def _tokens(block) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every token of a block: its words, and an end after each row."""
    rows = block.last - block.first
    n = len(block.hashes) + rows
    token, row = np.full(n, END, np.uint64), np.zeros(n, np.int64)
    place = np.arange(len(block.hashes)) + block.row
    token[place] = block.hashes
    row[place] = block.row
    row[np.cumsum(block.count + 1) - 1] = np.arange(rows)
    return token, row


def vocabulary(rows: DataFrame, shards: int) -> tuple[int, int, dict[int, int]]:
    """(N, V, counts of heavy words) of the training texts of rows (id, held, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for block in words_of(batch.column(2), BLOCK_BYTES):
                token, row = _tokens(block)
                words, n = np.unique(token[train[block.first + row]], return_counts=True)
                shard = _shard(words, shards)
                cut = np.searchsorted(shard, np.arange(shards + 1))
                full = np.flatnonzero(np.diff(cut))
                blobs = [
                    words[cut[s] : cut[s + 1]].tobytes()
                    + n[cut[s] : cut[s + 1]].astype(np.uint32).tobytes()
                    for s in full
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array(blobs, pa.binary())],
                    names=["shard", "blob"],
                )

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = [], []
        for batch in batches:
            for blob in batch.column(1):
                data = blob.as_buffer()
                n = data.size // 12
                words.append(np.frombuffer(data, np.uint64, n))
                counts.append(np.frombuffer(data, np.uint32, n, n * 8))
        if not words:
            return
        word, count = np.concatenate(words), np.concatenate(counts)
        order = np.argsort(word)
        word = word[order]
        first = _groups(word)
        sums = np.add.reduceat(count[order].astype(np.int64), first)
        much = np.flatnonzero(sums * HEAVY > sums.sum())  # a heavy word is one of its shard, too
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *word[first][much].view(np.int64).tolist()], pa.int64()),
                pa.array([int(sums.sum()), *sums[much].tolist()], pa.int64()),
                pa.array([len(first)] + [0] * len(much), pa.int64()),
            ],
            names=["word", "n", "distinct"],
        )

    packed = rows.mapInArrow(count, "shard int, blob binary").repartitionById(shards, "shard")
    found = checkpointed(packed.mapInArrow(total, "word long, n long, distinct long"))
    sums = found.where("word is null").agg(F.sum("n"), F.sum("distinct")).first()
    tokens, distinct = sums[0] or 0, sums[1] or 0
    heavy = found.where((F.col("word").isNotNull()) & (F.col("n") * HEAVY > tokens)).collect()
    return tokens, distinct, {r["word"]: r["n"] for r in heavy}


def _pack(word: np.ndarray, before: np.ndarray, code: np.ndarray) -> bytes:
    """Tokens sorted by word and context, with row and training flag as one number each."""
    new_word = np.concatenate([[True], word[1:] != word[:-1]])
    new_pair = new_word | np.concatenate([[True], before[1:] != before[:-1]])
    words, pairs = word[new_word], before[new_pair]
    return b"".join(
        (
            struct.pack("<3q", len(word), len(pairs), len(words)),
            words.tobytes(),
            np.ascontiguousarray(pairs.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes(),
            code.astype(np.uint16).tobytes(),
            np.packbits(new_pair).tobytes(),
            np.packbits(new_word[new_pair]).tobytes(),
        )
    )


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    """(word and context of each pair, pair of each token, row, training flag)."""
    n, pairs, words = struct.unpack_from("<3q", blob)
    at = 24
    word = np.frombuffer(blob, np.uint64, words, at)
    at += 8 * words
    before = np.zeros((pairs, 8), np.uint8)
    before[:, :6] = np.frombuffer(blob, np.uint8, 6 * pairs, at).reshape(-1, 6)
    at += 6 * pairs
    code = np.frombuffer(blob, np.uint16, n, at)
    at += 2 * n
    new_pair = np.unpackbits(np.frombuffer(blob, np.uint8, (n + 7) // 8, at), count=n)
    at += (n + 7) // 8
    new_word = np.unpackbits(np.frombuffer(blob, np.uint8, (pairs + 7) // 8, at), count=pairs)
    return (
        word[np.cumsum(new_word, dtype=np.int64) - 1],
        before.view(np.uint64).ravel(),
        np.cumsum(new_pair, dtype=np.int64) - 1,
        code >> 1,
        code & 1,
    )


def _split(batches: Iterator[pa.RecordBatch], shards: int, heavy: np.ndarray):
    """Per block of texts: a row for each text, and its pairs packed for each shard."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        train = ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for block in words_of(batch.column(2), BLOCK_BYTES):
            token, row = _tokens(block)
            before = np.concatenate([[END], token[:-1]]) & CONTEXT
            shard = _shard(token, shards)
            frequent = np.flatnonzero(np.isin(token, heavy))
            shard[frequent] = _shard(mix(token[frequent] ^ mix(before[frequent])), shards)
            order = np.lexsort((before, token))
            order = order[np.argsort(shard[order], kind="stable")]
            code = row * 2 + train[block.first + row]
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            token, before, code = token[order], before[order], code[order]
            full = np.flatnonzero(np.diff(cut))
            blobs = [
                _pack(*(a[cut[s] : cut[s + 1]] for a in (token, before, code))) for s in full
            ]
            rows = block.last - block.first
            here = slice(block.first, block.first + rows)
            none = pa.nulls(rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((np.arange(rows) + number) % shards, pa.int32()),
                    pa.array(np.full(rows, number)),
                    pa.array(np.arange(rows), pa.int32()),
                    batch.column(0)[here],
                    batch.column(1)[here],
                    pa.array(block.count + 1),
                    none,
                ],
                names=["shard", "block", "row", "id", "held", "n_tokens", "blob"],
            )
            for k in range(0, len(full), 64):
                part = full[k : k + 64]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part, pa.int32()),
                        pa.array(np.full(len(part), number)),
                        pa.nulls(len(part), pa.int32()),
                        pa.nulls(len(part), batch.column(0).type),
                        pa.nulls(len(part), pa.bool_()),
                        pa.nulls(len(part), pa.int64()),
                        pa.array(blobs[k : k + 64], pa.binary()),
                    ],
                    names=["shard", "block", "row", "id", "held", "n_tokens", "blob"],
                )
            number += 1


def shard_scores(
    pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]],
    heavy: dict[int, int],
    tokens: int,
    distinct: int,
    mu: float,
    folder: str,
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each block's (word, context, training count) pairs: score, base score, known flag.

    The trie's levels are written below ``folder`` while it is used.
    """
    sizes = [len(p[0]) for p in pairs]
    word, before, count = (np.concatenate(c) for c in zip(*pairs, strict=True))
    order = np.lexsort((before, word))
    word, before, count = word[order], before[order], count[order]
    apart = (word[1:] != word[:-1]) | (before[1:] != before[:-1])
    first = np.flatnonzero(np.concatenate([[True], apart]))
    pair_of = np.cumsum(np.concatenate([[False], apart]))
    word, before, count = word[first], before[first], np.add.reduceat(count, first)
    start = _groups(word)
    own = np.add.reduceat(count, start)
    for k, w in enumerate(word[start].view(np.int64).tolist()):
        if w in heavy:
            own[k] = heavy[w]
    single = own[np.cumsum(np.isin(np.arange(len(word)), start)) - 1].astype(float)
    mass = tokens + 0.5 * (distinct + 1)
    likely = (single + 0.5) / mass
    seen = np.flatnonzero(count)
    gain = np.log10(1 + count[seen] / (mu * likely[seen]))
    trie = PairTrie(word[seen], before[seen], gain, folder)
    try:
        gained = np.nan_to_num(trie.lookup(word, before))
    finally:
        trie.close()
    score = gained + np.log10(mu * likely) - np.log10(single + mu)
    back = np.empty(len(order), np.int64)
    back[order] = pair_of
    out, at = [], 0
    for size in sizes:
        mine = back[at : at + size]
        out.append((score[mine], np.log10(likely)[mine], single[mine] > 0))
        at += size
    return out


def language_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mu: float = 20.0
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row of docs.

    Texts are scored whole; texts whose id's CRC by 5 leaves 1 are not learnt from. A null or
    empty text is its end alone; null ids are training texts; repeated rows count and are
    scored each. With no training texts all tokens are unknown; an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    # A shard's pairs are held as arrays: half a shuffle partition each.
    shards = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.select("id", held_out(F.col("id")).alias("held"), "text")
    kind = dict(rows.dtypes)["id"]
    tokens, distinct, heavy = vocabulary(rows, shards)
    shipped = spark.sparkContext.broadcast(heavy)  # at most HEAVY words
    folder = f"{shared_dir(spark)}/lm-{uuid.uuid4().hex}"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.array(sorted(shipped.value), np.int64).view(np.uint64)
        yield from _split(batches, shards, words)

    schema = "block long, row int, id {0}, held boolean, n_tokens long, blob binary".format(kind)
    dealt = rows.mapInArrow(split, "shard int, " + schema).repartitionById(shards, "shard")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "row", "id", "held", "n_tokens", "blob"]
        block, unpacked, id_type = [], [], None
        for batch in batches:
            batch = batch.select(names)
            id_type = batch.column(2).type
            texts = batch.filter(batch.column(5).is_null())
            if texts.num_rows:
                yield texts
            packed = batch.filter(batch.column(5).is_valid())
            for number, blob in zip(packed.column(0).to_pylist(), packed.column(5), strict=True):
                block.append(number)
                unpacked.append(_unpack(blob.as_py()))
        if not block:
            return
        pairs = [
            (w, b, np.bincount(p, weights=t, minlength=len(w)).astype(np.int64))
            for w, b, p, _, t in unpacked
        ]
        made = shard_scores(pairs, shipped.value, tokens, distinct, mu, folder)
        for number, (_, _, pair, row, _), (s, base, known) in zip(
            block, unpacked, made, strict=True
        ):
            sums = [np.bincount(row, weights=v[pair]) for v in (s, base, known)]
            full = np.flatnonzero(np.bincount(row))
            blob = full.astype(np.uint16).tobytes() + b"".join(
                v[full].astype(k).tobytes()
                for v, k in zip(sums, (np.float64, np.float64, np.uint32), strict=True)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]),
                    pa.nulls(1, pa.int32()),
                    pa.nulls(1, id_type),
                    pa.nulls(1, pa.bool_()),
                    pa.nulls(1, pa.int64()),
                    pa.array([blob], pa.binary()),
                ],
                names=names,
            )

    back = dealt.mapInArrow(score, schema).repartition(shards, "block")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, list] = {}
        sums: dict[int, list] = {}
        for batch in batches:
            heads = batch.filter(batch.column(5).is_null())
            for number in heads.column(0).unique().to_pylist():
                mine = heads.filter(pa.compute.equal(heads.column(0), number))
                texts.setdefault(number, []).append(mine)
            packed = batch.filter(batch.column(5).is_valid())
            for number, blob in zip(packed.column(0).to_pylist(), packed.column(5), strict=True):
                held = sums.setdefault(number, [np.zeros(1 << 15) for _ in range(3)])
                data = blob.as_py()
                n = len(data) // 22
                row = np.frombuffer(data, np.uint16, n)
                held[0][row] += np.frombuffer(data, np.float64, n, 2 * n)
                held[1][row] += np.frombuffer(data, np.float64, n, 10 * n)
                held[2][row] += np.frombuffer(data, np.uint32, n, 18 * n)
        for number, parts in texts.items():
            for part in parts:
                row = part.column(1).to_numpy()
                score, base, known = (v[row] for v in sums[number])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(2),
                        part.column(3),
                        part.column(4),
                        pa.array(np.rint(known).astype(np.int64)),
                        pa.array(np.full(len(row), tokens)),
                        pa.array(base),
                        pa.array(score),
                    ],
                    names=[
                        "id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
                        "score",
                    ],
                )

    return back.mapInArrow(
        gather,
        f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
