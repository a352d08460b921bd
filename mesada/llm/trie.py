"""An n-gram trie in Elias-Fano levels that are memory-mapped.

The trie is of reversed pairs: its first level holds the last words, its second, under each of
them, the words found before it. Both levels are monotone sequences: words are 64-bit hashes in
ascending order, children are ranks in the level's own list of context words, raised by the
parent's number times the list's length. A child is thus looked up as a number relative to its
parent, by a search for the least element not below it. Where a parent's children begin is a
third monotone sequence. Each pair has two bytes: its quantised value's place in a codebook.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyarrow import fs

U = np.uint64
_MASKS = [U((1 << k) - 1) for k in range(64)]


def _mapped(folder: str, name: str, data: np.ndarray) -> np.ndarray:
    """The array from a file below the folder's URI, as a read-only memory map.

    A file system without maps hands out the file's bytes instead.
    """
    if not len(data):
        return data
    files, root = fs.FileSystem.from_uri(folder)
    if isinstance(files, fs.LocalFileSystem):
        files = fs.LocalFileSystem(use_mmap=True)
    with files.open_output_stream(f"{root}/{name}", compression=None) as out:
        out.write(np.ascontiguousarray(data).view(np.uint8).data)
    with files.open_input_file(f"{root}/{name}") as source:
        return np.frombuffer(source.read_buffer(), data.dtype)


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one bit (from 0) of each 64-bit word."""
    place = np.zeros(len(words), np.uint64)
    k = k.copy()
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count((words >> place) & _MASKS[width])
        upper = k >= below
        k = np.where(upper, k - below, k)
        place = np.where(upper, place + U(width), place)
    return place.astype(np.int64)


@dataclass
class EliasFano:
    """A monotone sequence of n numbers: low bits packed, high bits in unary.

    ``ones`` and ``zeros`` count bits before each word of the unary part, for select.
    """

    n: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray
    zeros: np.ndarray
    top: int  # the largest high part

    @classmethod
    def build(cls, values: np.ndarray, folder: str, name: str) -> EliasFano:
        """values: ascending uint64."""
        n = len(values)
        last = int(values[-1]) if n else 0
        low_bits = min(56, max(0, (last // max(1, n)).bit_length() - 1))
        upper = (values >> U(low_bits)).astype(np.int64)
        top = int(upper[-1]) if n else 0
        places = upper + np.arange(n)
        bits = np.zeros((n + top + 1 + 63) // 64 * 64 + 64, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        packed = np.zeros((n * low_bits + 7) // 8 + 8, np.uint8)
        for k in range(0, n, 1 << 20):  # whole bytes: 2^20 numbers end on one
            part = (values[k : k + (1 << 20)] & _MASKS[low_bits]).astype("<u8")
            spread = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            line = np.packbits(spread[:, :low_bits].ravel(), bitorder="little")
            at = k * low_bits // 8
            packed[at : at + len(line)] = line
        counts = np.bitwise_count(high).astype(np.int64)
        ones = np.concatenate([[0], np.cumsum(counts)])
        zeros = np.arange(len(high) + 1) * 64 - ones
        return cls(
            n,
            low_bits,
            _mapped(folder, f"{name}.low", packed),
            _mapped(folder, f"{name}.high", high),
            _mapped(folder, f"{name}.ones", ones),
            _mapped(folder, f"{name}.zeros", zeros),
            top,
        )

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        table = self.ones if ones else self.zeros
        word = np.searchsorted(table, k, "right") - 1
        bits = self.high[word]
        return word * 64 + _select_in_word(bits if ones else ~bits, k - table[word])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        eight = np.lib.stride_tricks.sliding_window_view(np.asarray(self.low), 8)[bit >> 3]
        value = np.ascontiguousarray(eight).view("<u8").ravel()
        return (value >> (bit & 7).astype(np.uint64)) & _MASKS[self.low_bits]

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        upper = self._select(i, ones=True) - i
        return (upper.astype(np.uint64) << U(self.low_bits)) | self._low(i)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Place of the first number not below each value; n if all are."""
        upper = (values >> U(self.low_bits)).astype(np.int64)
        beyond = upper > self.top
        upper = np.where(beyond, 0, upper)
        # Numbers with this high part stand between two zeros of the unary part.
        start = np.where(upper > 0, self._select(np.maximum(upper - 1, 0), ones=False) - upper + 1, 0)
        end = self._select(upper, ones=False) - upper
        wanted = values & _MASKS[self.low_bits]
        while (open_ := np.flatnonzero(start < end)).size:
            middle = (start[open_] + end[open_]) >> 1
            less = self._low(middle) < wanted[open_]
            start[open_] = np.where(less, middle + 1, start[open_])
            end[open_] = np.where(less, end[open_], middle)
        return np.where(beyond, self.n, start)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value; -1 where it is missing."""
        if not self.n:
            return np.full(len(values), -1)
        place = self.successor(values)
        held = np.minimum(place, self.n - 1)
        return np.where((place < self.n) & (self.get(held) == values), place, -1)


def quantise(values: np.ndarray, levels: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """(codes, codebook): bins of equal width over the values, each stood for by its mean.

    Bins of equal counts would save a byte, but put the few most frequent pairs in one bin.
    """
    if not len(values):
        return np.zeros(0, np.uint16), np.zeros(1)
    low, high = values.min(), values.max()
    codes = ((values - low) * ((levels - 1) / max(high - low, 1e-12))).astype(np.int64)
    n = np.bincount(codes, minlength=levels)
    book = np.bincount(codes, weights=values, minlength=levels) / np.maximum(n, 1)
    return codes.astype(np.uint16), book


class PairTrie:
    """Reversed word pairs with a quantised value each; see the module's text.

    pairs: (last, before) hashes in ascending order of both, without repeats; values go with
    them. The levels lie in a folder of their own below ``folder``, a URI, which close() removes.
    """

    def __init__(self, last: np.ndarray, before: np.ndarray, values: np.ndarray, folder: str):
        self.folder = f"{folder}/trie-{uuid.uuid4().hex}"
        files, root = fs.FileSystem.from_uri(self.folder)
        files.create_dir(root, recursive=True)
        words, first = np.unique(last, return_index=True)
        contexts = np.unique(before)
        self.words = EliasFano.build(words, self.folder, "words")
        self.contexts = EliasFano.build(contexts, self.folder, "contexts")
        parent = np.repeat(np.arange(len(words)), np.diff(np.append(first, len(last))))
        rank = np.searchsorted(contexts, before)
        children = (parent * len(contexts) + rank).astype(np.uint64)
        self.children = EliasFano.build(children, self.folder, "children")
        self.begins = EliasFano.build(
            np.append(first, len(last)).astype(np.uint64), self.folder, "begins"
        )
        codes, self.book = quantise(values)
        self.codes = _mapped(self.folder, "codes", codes)

    def lookup(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The value of each pair; not a number where the trie does not hold it."""
        out = np.full(len(last), np.nan)
        if not self.words.n:
            return out
        parent, rank = self.words.find(last), self.contexts.find(before)
        held = np.flatnonzero((parent >= 0) & (rank >= 0))
        wanted = (parent[held] * self.contexts.n + rank[held]).astype(np.uint64)
        place = self.children.find(wanted)
        found = place >= 0
        # A child of another parent cannot be met: numbers carry their parent.
        held, place = held[found], place[found]
        out[held] = self.book[self.codes[place]]
        return out

    def children_of(self, last: np.ndarray) -> np.ndarray:
        """How many context words each last word has."""
        parent = self.words.find(last)
        known = np.maximum(parent, 0)
        many = self.begins.get(known + 1) - self.begins.get(known)
        return np.where(parent >= 0, many.astype(np.int64), 0)

    def close(self) -> None:
        files, root = fs.FileSystem.from_uri(self.folder)
        files.delete_dir(root)
