"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and items are compared as code points, letters lower-cased, runs of blanks as one. An item
of m characters with an edit budget of k keeps at least ``m - q + 1 - k q`` of its q-grams, all
on diagonals at most k apart. So q-grams shared with a text are counted in bands of 2 (k + 1)
diagonals, each overlapping half of the next; a band that reaches the bound is aligned with the
item inside its diagonals, and counts if the alignment needs at most k edits.

To get there cheaply, an item is met through its k + 1 rarest disjoint q-grams, one of which
k edits must leave whole, and only places that hold all but k of its disjoint short pieces are
counted; both are bounds of the same kind and lose nothing.

The items are a reference set. Equal ones are one. They are read in blocks of a bounded number
of characters; each block's index is broadcast, the documents are scanned, and what is found
is written before the next block's turn.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesada.llm.common import checkpointed, id_and_text
from mesada.llm.words import U, blocks, powers, prefix, text_bytes

GRAM = 12
EDITS = 0.05
BITS = 20
SEGMENT = 1 << 21
BLOCK_CHARS = 8_000_000
#: Pairs of a place and an item, and cells of an alignment, that are held at once.
PAIRS = 1 << 20
CELLS = 1 << 18
#: Hits whose items would begin within so many characters are looked at together.
NEAR = 64

_LOWER = np.arange(1 << 16, dtype=np.uint32)
for _c in range(1 << 16):
    if len(chr(_c).lower()) == 1:
        _LOWER[_c] = ord(chr(_c).lower())
_BLANK = np.array([chr(c).isspace() for c in range(1 << 14)])


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points, lower-cased and with blanks merged, and the place of each in the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    low = codes < len(_LOWER)
    codes[low] = _LOWER[codes[low]]
    blank = np.zeros(len(codes), bool)
    small = codes < len(_BLANK)
    blank[small] = _BLANK[codes[small]]
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[:1] = True
    codes[blank] = 32
    places = np.flatnonzero(keep)
    return codes[places], places


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash for each q-gram of the code points, by its start."""
    n = len(codes) - q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    sums = prefix(codes.astype(np.uint64) * U(0xD6E8FEB86659FD93) + U(0x9FB21C651E98DF25))
    _, down = powers(len(sums))
    return (sums[q:] - sums[:-q]) * down[:n]


@dataclass
class Grams:
    """Seeds of the items that share a gram length, sorted by hash, and the items' short pieces."""

    q: int
    piece: int
    seeds: np.ndarray  # distinct hashes, ascending
    first: np.ndarray  # of each seed's occurrences; one more at the end
    item: np.ndarray
    offset: np.ndarray
    pieces: np.ndarray  # hashes of the disjoint pieces of all items, item by item
    piece_from: np.ndarray  # by item of the block
    piece_many: np.ndarray
    seen: np.ndarray  # by the upper bits of a hash


@dataclass
class Index:
    """A block of items."""

    ids: list
    codes: list[np.ndarray]
    budget: np.ndarray  # edits allowed
    q: np.ndarray  # gram length
    parts: list[Grams]


def _seeds(grams: np.ndarray, often: np.ndarray, q: int, many: int) -> np.ndarray:
    """Offsets of ``many`` disjoint q-grams that are rare in the block: the best grid of grams."""
    best, cost = np.zeros(0, np.int64), None
    for shift in range(min(q, len(grams) - q * (many - 1))):
        at = np.arange(shift, len(grams), q)
        at = at[np.argsort(often[at], kind="stable")[:many]]
        total = int(often[at].sum())
        if cost is None or total < cost:
            best, cost = at, total
    return best


def build_index(items: list[tuple], q: int = GRAM, edits: float = EDITS) -> Index:
    """items: (id, text). An item of m characters may take int(edits * m) edits, and is known by
    grams short enough that so many edits leave one of them: q, or less for short items, down
    to the whole item. Items without a character that is not blank never match."""
    ids, codes, budget, lengths = [], [], [], []
    for key, text in items:
        own = folded((text or "").strip())[0]
        if len(own):
            k = int(edits * len(own))
            ids.append(key)
            codes.append(own)
            budget.append(k)
            lengths.append(max(1, min(q, len(own) // (k + 1))))
    budget, lengths = np.array(budget, np.int64), np.array(lengths, np.int64)
    parts = []
    for length in np.unique(lengths).tolist():
        mine = np.flatnonzero(lengths == length).tolist()
        whole, often = np.unique(
            np.concatenate([np.unique(gram_hashes(codes[i], length)) for i in mine]),
            return_counts=True,
        )
        piece = max(1, length // 2)
        item, offset, seeds, pieces = [], [], [], []
        piece_many = np.zeros(len(ids), np.int64)
        for i in mine:
            grams = gram_hashes(codes[i], length)
            at = _seeds(grams, often[np.searchsorted(whole, grams)], length, int(budget[i]) + 1)
            seeds.append(grams[at])
            offset.append(at)
            item.append(np.full(len(at), i))
            pieces.append(gram_hashes(codes[i], piece)[::piece])
            piece_many[i] = len(pieces[-1])
        seed = np.concatenate(seeds)
        order = np.argsort(seed, kind="stable")
        distinct, first = np.unique(seed[order], return_index=True)
        seen = np.zeros(1 << BITS, bool)
        seen[(distinct >> U(64 - BITS)).astype(np.int64)] = True
        parts.append(
            Grams(
                length, piece, distinct, np.append(first, len(seed)),
                np.concatenate(item)[order], np.concatenate(offset)[order],
                np.concatenate(pieces), np.cumsum(piece_many) - piece_many, piece_many, seen,
            )
        )
    return Index(ids, codes, budget, lengths, parts)


def _runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of places whose sizes sum up to at most ``limit``, or single ones."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, last
        first = last


def _spread(first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, entry): the entries first .. first + many - 1 of each."""
    which = np.repeat(np.arange(len(many)), many)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + first[which]


def seed_hits(codes: np.ndarray, part: Grams) -> Iterator[tuple[np.ndarray, ...]]:
    """(place in the text, item, offset in the item) of every seed in a text, PAIRS at a time."""
    for at in range(0, max(0, len(codes) - part.q + 1), SEGMENT):
        grams = gram_hashes(codes[at : at + SEGMENT + part.q - 1], part.q)
        place = np.flatnonzero(part.seen[(grams >> U(64 - BITS)).astype(np.int64)])
        rank = np.minimum(np.searchsorted(part.seeds, grams[place]), len(part.seeds) - 1)
        true = part.seeds[rank] == grams[place]
        place, rank = place[true] + at, rank[true]
        many = part.first[rank + 1] - part.first[rank]
        for a, b in _runs(many, PAIRS):
            # A seed of very many items is met by some of them at a time.
            for skip in range(0, int(many[a:b].max()), PAIRS):
                left = np.clip(many[a:b] - skip, 0, PAIRS)
                which, entry = _spread(part.first[rank[a:b]] + skip, left)
                yield place[a:b][which], part.item[entry], part.offset[entry]


def _plausible(
    codes: np.ndarray, index: Index, part: Grams, cut: np.ndarray, hits: tuple[np.ndarray, ...]
) -> np.ndarray:
    """Pairs (row * items + item) that a hit may stand for: all but ``budget`` of the item's
    disjoint pieces lie around the hit. Hits close to each other are looked at together."""
    place, item, offset = hits
    row = np.searchsorted(cut, place, "right") - 1
    start = place - offset
    key = row * (len(codes) // NEAR + 2) + np.maximum(start, 0) // NEAR
    order = np.argsort(key, kind="stable")
    key, row, start, item = key[order], row[order], start[order], item[order]
    edges = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key))
    lengths = part.piece_many * part.piece + part.piece
    found = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        these = np.unique(item[a:b])
        reach = int(index.budget[these].max())
        low = max(int(cut[row[a]]), int(start[a:b].min()) - reach)
        high = int((start[a:b] + lengths[item[a:b]]).max()) + reach
        around = np.unique(gram_hashes(codes[low : min(high, int(cut[row[a] + 1]) - 1)], part.piece))
        if not len(around):
            continue
        many = part.piece_many[these]
        _, entry = _spread(part.piece_from[these], many)
        pieces = part.pieces[entry]
        at = np.minimum(np.searchsorted(around, pieces), len(around) - 1)
        missing = np.add.reduceat(around[at] != pieces, np.cumsum(many) - many)
        found.append(row[a] * len(index.ids) + these[missing <= index.budget[these]])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


class SharedGrams:
    """The q-grams that a text shares with an item, by place and offset, PAIRS at a time."""

    def __init__(self, grams: np.ndarray, begin: int, item: np.ndarray, q: int):
        own = gram_hashes(item, q)
        self.offset = np.argsort(own, kind="stable")
        distinct, first, many = np.unique(own[self.offset], return_index=True, return_counts=True)
        rank = np.minimum(np.searchsorted(distinct, grams), len(distinct) - 1)
        self.place = np.flatnonzero(distinct[rank] == grams)
        self.first, self.many = first[rank[self.place]], many[rank[self.place]]
        self.place += begin

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a, b in _runs(self.many, PAIRS):
            which, entry = _spread(self.first[a:b], self.many[a:b])
            yield self.place[a:b][which], self.offset[entry]


def align(item: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int, int]:
    """(edits, start, end) of the item's best place in the text on diagonals low .. low+width-1.

    A cell holds its edits above its start place, so that one minimum carries both. Beyond the
    text stand codes that match nothing; to replace one costs what leaving out the item's
    character does, so edits stay right, and places are clipped to the text.
    """
    one = np.int64(1 << 32)
    m, n = len(item), len(text)
    around = np.full(m + width, -1, np.int64)  # text[low : low + m + width]
    first, last = max(0, low), min(n, low + m + width)
    if first < last:
        around[first - low : last - low] = text[first:last]
    steps = np.arange(width, dtype=np.int64) * one
    cells = np.clip(np.arange(low, low + width, dtype=np.int64), 0, n)
    windows = np.lib.stride_tricks.sliding_window_view(around, width)
    rows = max(1, CELLS // width)  # compared at a time
    for at in range(0, m, rows):
        # Replacing or keeping moves along a diagonal; leaving out comes from the next diagonal.
        last = min(m, at + rows)
        for row in (windows[at:last] != item[at:last, None]) * one:
            step = cells + row
            np.minimum(step[:-1], cells[1:] + one, out=step[:-1])
            step -= steps
            np.minimum.accumulate(step, out=step)
            step += steps
            cells = step
    best = int(np.argmin(cells))
    value = int(cells[best])
    return value >> 32, value & int(one - 1), min(n, max(0, low + best + m))


def _overlaps(taken: list[tuple], start: int, end: int) -> bool:
    """Whether start .. end-1 meets one of the spans, which are sorted and apart from each other."""
    at = bisect_left(taken, (end,))
    return at > 0 and taken[at - 1][1] > start


def _full_bands(
    grams: SharedGrams, free_from: np.ndarray, free_to: np.ndarray, q: int, width: int, lead: int,
    span: int, bound: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(gap * span + lowest diagonal + lead, shared grams) of bands that reach the bound."""
    keys, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(back, np.concatenate(counts), len(key)).astype(np.int64)

    for place, offset in grams:
        gap = np.searchsorted(free_to[:-1], place, "right")
        inside = (place >= free_from[gap]) & (place + q <= free_to[gap])
        diagonal, gap = (place - offset)[inside], gap[inside]
        for by in (0, width // 2):
            low = (diagonal + by) // width * width - by
            key, n = np.unique(gap * span + low + lead, return_counts=True)
            keys.append(key)
            counts.append(n)
            held += len(key)
        if held > PAIRS:
            key, n = merged()
            keys, counts, held = [key], [n], 0
    key, shared = merged()
    full = np.flatnonzero(shared >= bound)
    full = full[np.argsort(-shared[full], kind="stable")]
    return key[full], shared[full]


def _missing(pieces: np.ndarray, codes: np.ndarray, size: int) -> int:
    """How many of the pieces' hashes occur nowhere in the codes."""
    around = np.sort(gram_hashes(codes, size))
    if not len(around):
        return len(pieces)
    at = np.minimum(np.searchsorted(around, pieces), len(around) - 1)
    return int(np.count_nonzero(around[at] != pieces))


def _regions(
    codes: np.ndarray, begin: int, end: int, grams: SharedGrams, q: int, item: np.ndarray,
    budget: int, every: bool,
) -> list[tuple]:
    """(start, end, edits, shared) of an item in codes[begin:end], apart from each other; the first
    found if not ``every``.

    The best places of a round are taken. What they leave free is searched again, by the shared
    q-grams that lie in it, until no place is left. A band that meets an exact place waits for
    the next round.
    """
    width, m = 2 * (budget + 1), len(item)
    bound = m - q + 1 - budget * q
    size = max(1, q // 2)
    pieces = gram_hashes(item, size)[::size]
    lead, span = m + width, end + 2 * (m + width)
    taken: list[tuple] = []
    while True:
        free_from = np.array([begin, *(t[1] for t in taken)])
        free_to = np.array([*(t[0] for t in taken), end])
        key, shared = _full_bands(grams, free_from, free_to, q, width, lead, span, bound)
        exact: list[tuple] = []
        hits = []
        for j in range(len(key)):
            g, at = divmod(int(key[j]), span)
            at -= lead
            if _overlaps(exact, at, at + m):
                continue
            first = max(int(free_from[g]), at - budget)
            last = min(int(free_to[g]), at + width + m + budget)
            if _missing(pieces, codes[first:last], size) > budget:
                continue
            found = align(item, codes[first:last], at - budget - first, 4 * budget + 2)
            s, e = first + found[1], first + found[2]
            if found[0] <= budget and s < e:
                hits.append((found[0], s, e, int(shared[j])))
                if not every:
                    return [(s, e, found[0], int(shared[j]))]
                if found[0] == 0 and not _overlaps(exact, s, e):
                    insort(exact, (s, e))
        if not hits:
            return taken
        for edits, s, e, n in sorted(hits, key=lambda h: h[:3]):
            if not _overlaps(taken, s, e):
                insort(taken, (s, e, edits, n))


def find_items(text_rows: list[str], index: Index, every: bool = True) -> list[tuple]:
    """(row, item, start, end, edits, shared) for each item in each text, at every place that does
    not overlap a better one; at one place only if not ``every``.

    An occurrence within the budget of k edits keeps one of any k + 1 disjoint grams of the
    item. So a text meets an item first through its k + 1 rarest, and a gram that many items
    share is met where it is among these only. What is met must hold all but k of the item's
    disjoint short pieces nearby; then all shared grams are counted in bands.
    """
    if not index.ids:
        return []
    codes, places = folded("\x00".join(text_rows) + "\x00")
    starts = np.zeros(len(text_rows) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in text_rows], out=starts[1:])
    cut = np.searchsorted(places, starts)  # blanks never merge across the separator
    pairs = np.zeros(0, np.int64)
    for part in index.parts:
        for hits in seed_hits(codes, part):
            if len(hits[0]):
                more = _plausible(codes, index, part, cut, hits)
                pairs = np.union1d(pairs, more) if len(more) else pairs
    out = []
    held: tuple = (None, None)  # the grams of the row at hand, by their length
    for p in pairs.tolist():
        r, i = divmod(p, len(index.ids))
        if not every and out and out[-1][0] == r:
            continue
        begin, end, q = int(cut[r]), int(cut[r + 1]) - 1, int(index.q[i])
        if held[0] != (r, q):
            held = ((r, q), gram_hashes(codes[begin:end], q))
        grams = SharedGrams(held[1], begin, index.codes[i], q)
        item = index.codes[i].astype(np.int64)
        for s, e, edits, n in _regions(codes, begin, end, grams, q, item, int(index.budget[i]), every):
            start, stop = int(places[s] - starts[r]), int(places[e - 1] + 1 - starts[r])
            out.append((r, i, start, stop, edits, n))
    return out


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Items (item_id, key) and the distinct texts behind them (key, text)."""
    items = benchmark.select(
        F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text")
    ).where("text is not null")
    items = items.withColumn("key", F.sha2("text", 256))
    return items.select("item_id", "key"), items.select("key", "text").distinct()


def _blocks(texts: DataFrame, q: int, edits: float, block_chars: int) -> Iterator[tuple[Index, bool]]:
    """One index a block of distinct items, and whether it is the last; blocks are dealt by hash
    and held to about ``block_chars`` characters, or a single item."""
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    many = max(1, -(-total // block_chars))
    for k in range(many):
        part = texts.where(F.pmod(F.xxhash64("key"), F.lit(many)) == k)
        yield build_index([(r["key"], r["text"]) for r in part.toLocalIterator()], q, edits), many == 1


def _scan(texts: pa.Array, index: Index, every: bool = True) -> Iterator[tuple]:
    """find_items over a column, in runs of rows of bounded size."""
    texts = pc.fill_null(texts, "")
    for first, last in blocks(text_bytes(texts)[1], SEGMENT):
        for r, *rest in find_items(texts[first:last].to_pylist(), index, every):
            yield first + r, *rest


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    q: int = GRAM,
    edits: float = EDITS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, item_id, start, end, edits, shared): a row per row of docs and place of an item in it.

    Places of one item do not overlap; of overlapping ones the best is given. Places are code
    points of the text. Null texts are empty and match nothing, as do null and blank items;
    items too short for an edit are searched exactly, down to one character. Equal items are
    each reported; repeated rows each have theirs. An empty table on either side gives an
    empty result. Of several blocks, each one's matches are written before the next begins.
    """
    rows = id_and_text(docs, id_col, text_col)
    spark = rows.sparkSession
    kind = dict(rows.dtypes)["id"]
    items, texts = _items(benchmark, item_id_col, item_text_col)
    schema = f"id {kind}, key string, start long, end long, edits long, shared long"
    out = None
    for index, alone in _blocks(texts, q, edits, block_chars):
        held = spark.sparkContext.broadcast(index)  # about block_chars characters

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(_scan(batch.column(1), held.value))
                if not found:
                    continue
                ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                keys = pa.array([held.value.ids[f[1]] for f in found])
                cols = [pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4, 5)]
                yield pa.RecordBatch.from_arrays(
                    [ids, keys, *cols], names=["id", "key", "start", "end", "edits", "shared"]
                )

        made = rows.mapInArrow(run, schema)
        if not alone:
            made = checkpointed(made)
            held.destroy()
        out = made if out is None else out.unionByName(made)
    return out.join(items, "key").select("id", "item_id", "start", "end", "edits", "shared")


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    q: int = GRAM,
    edits: float = EDITS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of docs in which no item of the benchmark is found, with the columns of docs."""
    spark = docs.sparkSession
    out = docs
    _, texts = _items(benchmark, "item_id", "text")
    for index, alone in _blocks(texts, q, edits, block_chars):
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(batch.schema.get_field_index(text_col))
                clean = np.ones(batch.num_rows, bool)
                clean[[f[0] for f in _scan(column, held.value, every=False)]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
        if not alone:
            out = checkpointed(out)
            held.destroy()
    return out
