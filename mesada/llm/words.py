"""Words of whole Arrow columns as arrays: places and 64-bit hashes, without a Python object each.

Words are runs of bytes other than blank and 0x09-0x0D; A-Z counts as a-z. A word's hash is a
polynomial of its bytes' random 64-bit codes, taken from prefix sums. Texts are taken in blocks
of bounded size, so memory does not grow with a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CODES = np.random.default_rng(20240201).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
LOWER_CODES = _CODES.copy()
LOWER_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
ROWS = 30_000
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all bits."""
    h = (h ^ (h >> U(31))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n-1, at least, of the base and of its inverse."""
    if len(_POWERS["up"]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for key, base in (("up", BASE), ("down", BASE_INVERSE)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS[key] = np.cumprod(row)
    return _POWERS["up"], _POWERS["down"]


def prefix(codes: np.ndarray) -> np.ndarray:
    """Sums of code[i] * base^i before each place."""
    up, _ = powers(len(codes))
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of the codes, wherever it lies."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array without nulls, and the offsets of its rows."""
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], kind)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of the rows first .. last-1 of a column; starts and ends count from the first byte."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    row: np.ndarray  # of each word, from 0 for the block's first row
    count: np.ndarray  # words of each row


def blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of whole rows with at most ``limit`` bytes, or a single row; at most ROWS of them."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, first + ROWS, max(first + 1, last))
        yield first, last
        first = last


def words_of(texts: pa.Array, limit: int = 1 << 21) -> Iterator[Words]:
    """The words of a string array without nulls, block by block."""
    data, offsets = text_bytes(texts)
    for first, last in blocks(offsets, limit):
        part = data[offsets[first] : offsets[last]]
        cut = offsets[first : last + 1] - offsets[first]
        solid = np.zeros(len(part) + 2, bool)
        solid[1:-1] = ~BLANKS[part]
        # A row's first byte starts a word even if the row before has no blank at its end.
        edge = solid[1:] != solid[:-1]
        seam = cut[1:-1]
        seam = seam[(seam > 0) & (seam < len(part))]
        seam = np.unique(seam[solid[seam] & solid[seam + 1]])
        places = np.flatnonzero(edge)
        if len(seam):
            places = np.sort(np.concatenate([places, seam, seam]))
        starts, ends = places[0::2], places[1::2]
        hashes = span_hash(prefix(LOWER_CODES[part]), starts, ends)
        row = np.searchsorted(cut, starts, "right") - 1
        yield Words(
            first, last, part, starts, ends, hashes, row, np.bincount(row, minlength=last - first)
        )
