"""SentencePiece encoding with spans in the original text, and decoding.

A model file is read for its pieces and its normaliser. Normalisation replaces the longest
prefix that the compiled character map (a double-array trie) knows, and records for every byte
it writes the place it came from; piece lengths summed over the normalised text then project
every piece to a span of original bytes.

Pieces come from the sentencepiece library. Where the model's map is empty, blanks are kept and
no piece has a blank after another character, a text is the sum of its words with the blanks
before them, and each distinct word is encoded once and remembered; otherwise texts are encoded
whole.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from mesada.llm.common import fresh, id_and_text, map_text

SPACE = "▁"
SPACE_BYTES = SPACE.encode()
REMEMBERED = 500_000
TEXTS_AT_ONCE = 64
#: Bytes of text encoded in one run: ids, spans and decoded texts take several times as many.
ENCODED_AT_ONCE = 1 << 20
_RUNS = re.compile(" *[^ ]+| +$")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message; nested messages as bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(wire)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """The compiled map: a trie in a double array, and the replacements it points to."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]
        self.heads = {b for b in range(256) if self._child(self._root(), b) is not None}

    def _base(self, unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _root(self) -> int:
        return self._base(self.units[0]) if self.units else 0

    def _child(self, base: int, byte: int) -> tuple[int, int] | None:
        """The unit reached from a node's base by a byte, and its own base."""
        at = base ^ byte
        if at >= len(self.units):
            return None
        unit = self.units[at]
        if unit & 0x800000FF != byte:
            return None
        return unit, at ^ self._base(unit)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes of the longest known prefix of data[at:], and what replaces them."""
        base, found = self._root(), None
        for end in range(at, len(data)):
            step = self._child(base, data[end])
            if step is None:
                break
            unit, base = step
            if unit & 256:
                start = self.units[base] & 0x7FFFFFFF
                found = end + 1 - at, self.texts[start : self.texts.index(b"\0", start)]
        return found


class Model:
    """Pieces and normaliser of a model file, and the library's processor for it."""

    def __init__(self, proto: bytes):
        self.pieces: list[bytes] = []
        self.kinds: list[int] = []
        self.prefix, self.strip, self.escape, self.suffix = True, True, True, False
        charmap = b""
        for field, value in message_fields(proto):
            if field == 1:
                piece = dict(message_fields(value))
                self.pieces.append(piece.get(1, b""))
                self.kinds.append(piece.get(3, 1))
            elif field == 2:
                self.suffix = bool(dict(message_fields(value)).get(24, 0))
            elif field == 3:
                norm = dict(message_fields(value))
                charmap = norm.get(2, b"")
                self.prefix, self.strip, self.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        self.map = CharacterMap(charmap)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=proto)
        # Kind 6 is a byte; others are as long as their text. Unknown pieces vary.
        self.lengths = np.array(
            [1 if k == 6 else len(p) for p, k in zip(self.pieces, self.kinds, strict=True)]
        )
        self.unknown = {i for i, k in enumerate(self.kinds) if k == 2}
        inner = any(SPACE_BYTES in p.lstrip(SPACE_BYTES) for p in self._blank_first())
        self.by_words = (
            not self.map.units
            and self.prefix
            and self.escape
            and not (self.strip or self.suffix or inner or 4 in self.kinds)
            and 6 in self.kinds
            and SPACE_BYTES in self.pieces
        )
        self.known: dict[str, bytes] = {}
        self.decimals = [str(k) for k in range(len(self.pieces))]

    def _blank_first(self) -> Iterator[bytes]:
        """Pieces without their leading blanks, so that any blank left is an inner one."""
        for piece in self.pieces:
            while piece.startswith(SPACE_BYTES):
                piece = piece[len(SPACE_BYTES) :]
            yield b"x" + piece

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised bytes and, for each of them and the end, its place in the original."""
        data = text.encode()
        if not self.map.units and not self.strip:
            return self._escaped(data)
        out, places = bytearray(), []

        def put(piece: bytes, start: int, exact: bool) -> None:
            for k, byte in enumerate(piece):
                wide = SPACE_BYTES if byte == 32 and self.escape else bytes([byte])
                out.extend(wide)
                places.extend([start + k * exact] * len(wide))

        chunks, at = [], 0
        while at < len(data):
            hit = self.map.longest(data, at) if data[at] in self.map.heads else None
            if hit is None:
                size = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
                chunks.append((data[at : at + size], at, True))
            else:
                size = hit[0]
                chunks.append((hit[1], at, hit[1] == data[at : at + size]))
            at += size
        end = len(data)
        if self.strip:
            blank = [not c[0].strip(b" ") for c in chunks]
            first = next((k for k, b in enumerate(blank) if not b), len(chunks))
            last = next((k for k in range(len(chunks), 0, -1) if not blank[k - 1]), 0)
            if last < len(chunks):
                end = chunks[last][1]
            chunks = chunks[first:last]
        if not chunks:
            return b"", np.array([0])
        gap = SPACE_BYTES if self.escape else b" "
        if self.prefix and not self.suffix:
            out.extend(gap)
            places.extend([chunks[0][1]] * len(gap))
        for piece, start, exact in chunks:
            ended = out.endswith(gap)
            if self.strip and ended:
                kept = piece.lstrip(b" ")
                start += (len(piece) - len(kept)) * exact
                piece = kept
            put(piece, start, exact)
        if self.strip:
            while out.endswith(gap):
                end = places[-len(gap)]
                del out[-len(gap) :], places[-len(gap) :]
        if self.prefix and self.suffix:
            out.extend(gap)
            places.extend([end] * len(gap))
        return bytes(out), np.array([*places, end])

    def _escaped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """As normalise, for an empty map and kept blanks: array operations only."""
        if not data:
            return b"", np.array([0])
        gap = SPACE_BYTES if self.escape else b" "
        wide = np.ones(len(data), np.int64)
        wide[np.frombuffer(data, np.uint8) == 32] = len(gap)
        places = np.repeat(np.arange(len(data)), wide)
        out = data.replace(b" ", gap)
        if self.prefix and not self.suffix:
            out, places = gap + out, np.concatenate([np.zeros(len(gap), np.int64), places])
        if self.prefix and self.suffix:
            out = out + gap
            places = np.concatenate([places, np.full(len(gap), len(data))])
        return out, np.append(places, len(data))

    def _words(self, text: str) -> list[str]:
        """A text's words, each with the blanks before it but the first: the prefix stands for it."""
        text = text.replace(SPACE, " ")  # both normalise to the same
        words = text.split(" ") if text else []
        return [w[1:] for w in _RUNS.findall(" " + text)] if "" in words else words

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text. Words not yet known are encoded in one call for many texts."""
        if not self.by_words:
            for text in texts:
                yield np.array(self.processor.encode(text), np.int32)
            return
        for first in range(0, len(texts), TEXTS_AT_ONCE):
            split = [self._words(t) for t in texts[first : first + TEXTS_AT_ONCE]]
            new = {w for words in split for w in words if w not in self.known}
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = {w for words in split for w in words}
            listed = [w for w in new if w]
            for word, ids in zip(listed, self.processor.encode(listed), strict=True):
                self.known[word] = array("i", ids).tobytes()
            if "" in new:
                self.known[""] = array("i", [self.pieces.index(SPACE_BYTES)]).tobytes()
            for words in split:
                yield np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each piece, in bytes of the original text."""
        normal, places = self.normalise(text)
        sizes = self.lengths[ids]
        gap = len(normal) - int(sizes.sum())
        if gap or (self.unknown and np.isin(ids, list(self.unknown)).any()):
            sizes = self._measured(normal, ids)
        ends = np.cumsum(sizes)
        return places[ends - sizes], places[ends]

    def _measured(self, normal: bytes, ids: np.ndarray) -> np.ndarray:
        """Lengths of pieces when some are unknown: these reach up to the next known piece."""
        sizes, at = [], 0
        for k, piece in enumerate(ids):
            if int(piece) in self.unknown:
                after = self.pieces[ids[k + 1]] if k + 1 < len(ids) else b""
                stop = normal.find(after, at + 1) if after else len(normal)
                size = (stop if stop > at else len(normal)) - at
            else:
                size = int(self.lengths[piece])
            sizes.append(size)
            at += size
        return np.array(sizes, np.int64)

    def decode(self, ids: np.ndarray) -> str:
        return self.processor.decode(ids.tolist()) if len(ids) else ""


_LOADED: dict[str, Model] = {}


def load(proto: bytes) -> Model:
    """The model of a file's bytes; one for each Python worker."""
    key = hashlib.sha256(proto).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Model(proto)
    return _LOADED[key]


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _shipped(docs: DataFrame, model_path: str):
    """The model file, read once by the driver: its size does not depend on the data."""
    with open(model_path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _encoder(shipped):
    def work(texts: pa.Array) -> list:
        model = load(shipped.value)
        ids, starts, ends, decoded = [], [], [], []
        listed = texts.to_pylist()
        for text, got in zip(listed, model.encode_all(listed), strict=True):
            start, end = model.spans(text, got)
            ids.append(got)
            starts.append(start.astype(np.int32))
            ends.append(end.astype(np.int32))
            decoded.append(model.decode(got))
        ints = pa.list_(pa.int32())
        return [*(pa.array(c, ints) for c in (ids, starts, ends)), pa.array(decoded, pa.string())]

    return work


def encoded(
    docs: DataFrame, model_path: str, text_col: str = "text", spans: bool = True
) -> DataFrame:
    """docs with token_ids, token_starts, token_ends and decoded.

    Spans are bytes of the text's UTF-8. A null or empty text has no tokens and decodes to the
    empty text. Where docs has columns of these names, the new ones get underscores before them.
    """
    names = fresh(docs, "token_ids", "token_starts", "token_ends", "decoded")
    kinds = ["array<int>"] * 3 + ["string"]
    fields = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))
    work = _encoder(_shipped(docs, model_path))
    out = map_text(docs, text_col, work, fields, at_once=ENCODED_AT_ONCE)
    return out if spans else out.drop(*names[1:])


def encoding_digests(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, span_bytes, spans_sha256) a row of docs.

    Digests of what ``encoded`` returns, made where the text is encoded. ``span_bytes`` sums the
    spans; ``spans_sha256`` is of all starts, then all ends, as 4-byte little-endian numbers.
    Null and empty texts have no tokens; ids are handed on as they are; an empty table gives an
    empty result.
    """
    shipped = _shipped(docs, model_path)

    def work(texts: pa.Array) -> list:
        model = load(shipped.value)
        out: list[list] = [[], [], [], [], []]
        listed = texts.to_pylist()
        for text, ids in zip(listed, model.encode_all(listed), strict=True):
            start, end = model.spans(text, ids)
            numbers = ids.tolist()
            made = (
                len(ids),
                _sha(",".join([model.decimals[i] for i in numbers]).encode()),
                _sha(model.decode(ids).encode()),
                int((end - start).sum()),
                _sha(np.concatenate([start, end]).astype("<i4").tobytes()),
            )
            for column, value in zip(out, made, strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        return [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]

    fields = (
        "n_tokens long, ids_sha256 string, decoded_sha256 string, span_bytes long, "
        "spans_sha256 string"
    )
    return map_text(id_and_text(docs, id_col, text_col), "text", work, fields, drop_text=True)
