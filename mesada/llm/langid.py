"""Language identification by compression.

Each learned language has a raw-content zstandard dictionary: pieces of its training texts. A
text is lower-cased, all but its letters become single blanks, and its whole length is cut into
blocks that are compressed by themselves with the dictionary of each language in turn. The
language with the fewest compressed bytes in total is the answer; where the runner-up needs
hardly more, the answer is marked as rejected. Blocks are small, so that a block cannot live
on its own history instead of the dictionary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesada.llm.common import fresh, map_text

#: Bounds of what is learned: pieces of PIECE characters from at most PIECES texts a language,
#: DICTIONARY bytes a language, TOTAL bytes of all, the LANGUAGES most frequent languages.
PIECE = 1_024
PIECES = 160
DICTIONARY = 128 << 10
TOTAL = 48 << 20
LANGUAGES = 512
BLOCK = 1_024
LEVEL = 3
UNKNOWN = "und"


@dataclass(frozen=True)
class Languages:
    """What is learned: languages, most frequent first, and their dictionaries' bytes."""

    names: tuple[str, ...]
    contents: tuple[bytes, ...]


def held_out(ident: Column) -> Column:
    """Remainder 2 of the id's CRC by 4; a null id is a training text."""
    return F.coalesce(F.crc32(ident.cast("string")) % 4 == 2, F.lit(False))


def letters(texts: pa.Array) -> pa.Array:
    """Lower-case texts in which each run of other characters than letters is a blank."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"\P{L}+", " ")


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Languages:
    """Dictionaries from a bounded sample of the rows of docs that have a text and a language.

    The sample takes the texts with the smallest hashes of text and id, and of each a piece
    from a place that the hash tells, so that no text fills a dictionary alone. Pieces that
    are equal count once. No labelled row: no language.
    """
    known = docs.select(
        F.col(f"`{lang_col}`").alias("lang"),
        F.col(f"`{text_col}`").alias("text"),
        F.xxhash64(F.col(f"`{text_col}`"), F.col(f"`{id_col}`")).alias("h"),
    ).where("lang is not null and text is not null")
    counts = (
        known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    )
    room = F.greatest(F.length("text") - (PIECE - 1), F.lit(1)).cast("long")
    piece = F.col("text").substr((F.pmod("h", room) + 1).cast("int"), F.lit(PIECE))
    order = Window.partitionBy("lang").orderBy("h", "piece")
    rows = (
        known.where(F.col("lang").isin([r["lang"] for r in counts]))
        .select("lang", "h", piece.alias("piece"))
        .withColumn("k", F.row_number().over(order))
        .where(F.col("k") <= PIECES)
        .select("lang", "k", "piece")
        .collect()  # at most LANGUAGES x PIECES x PIECE characters
    )
    size = min(DICTIONARY, TOTAL // max(1, len(counts)))
    pieces: dict[str, dict[str, None]] = {}
    for r in sorted(rows, key=lambda r: r["k"]):
        pieces.setdefault(r["lang"], {})[r["piece"]] = None
    names = [r["lang"] for r in counts]
    contents = []
    for name in names:
        made = letters(pa.array(list(pieces[name]), pa.string())).to_pylist()
        contents.append(" ".join(made).encode()[:size])
    return Languages(tuple(names), tuple(contents))


class Classifier:
    """Compressors of a task, one for each language."""

    def __init__(self, model: Languages):
        self.names = model.names
        self.packers = []
        for content in model.contents:
            if len(content) < 8:  # too short for a dictionary
                made = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
            else:
                kept = zstandard.ZstdCompressionDict(
                    content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
                )
                kept.precompute_compress(level=LEVEL)
                made = zstandard.ZstdCompressor(
                    dict_data=kept, write_content_size=False, write_dict_id=False
                )
            self.packers.append(made)

    def sizes(self, text: bytes) -> list[int]:
        """Compressed bytes of a text's blocks by each language's dictionary."""
        blocks = [text[k : k + BLOCK] for k in range(0, len(text), BLOCK)]
        return [sum(len(p.compress(b)) for b in blocks) for p in self.packers]

    def judge(self, text: str) -> tuple[str, float]:
        """(language, margin) of a normalised text; ties go to the more frequent language."""
        if not text.strip() or not self.names:
            return UNKNOWN, 0.0
        sizes = self.sizes(text.encode())
        order = np.argsort(sizes, kind="stable")
        best = sizes[order[0]]
        if len(sizes) == 1:
            return self.names[0], 1.0
        second = sizes[order[1]]
        return self.names[order[0]], (second - best) / second


def identify(docs: DataFrame, model: Languages, text_col: str = "text", margin: float = 0.01):
    """docs with lang_pred, score and rejected, by the text alone.

    The score is the share of the runner-up's bytes that the best language saves, 0 to 1 (1 if
    only one language is learned); ``rejected`` says that it is below ``margin``. A text that
    is null, empty or without a letter, and any text if no language is learned, is ``und``
    with score 0, rejected. Texts are taken whole, whatever their length; equal texts get
    equal answers; an empty table gives an empty result. Columns of docs with these names are
    kept, the new ones then begin with an underscore.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # at most TOTAL bytes

    held: list[Classifier] = []

    def work(texts: pa.Array) -> list:
        if not held:
            held.append(Classifier(shipped.value))
        found = [held[0].judge(t) for t in letters(texts).to_pylist()]
        scores = [s for _, s in found]
        return [
            pa.array([n for n, _ in found], pa.string()),
            pa.array(scores, pa.float64()),
            pa.array([n == UNKNOWN or s < margin for n, s in found], pa.bool_()),
        ]

    names = fresh(docs, "lang_pred", "score", "rejected")
    kinds = ("string", "double", "boolean")
    fields = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))
    return map_text(docs, text_col, work, fields)


def language_predictions(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    margin: float = 0.01,
) -> DataFrame:
    """(id, held_out, lang_pred, score, rejected) of each row, learned from rows not held out.

    A row is held out if its id's CRC leaves 2 by 4. Null ids are training rows; repeated rows
    are each answered. Other columns than the text are never seen by a prediction.
    """
    ident = F.col(f"`{id_col}`")
    model = learn(docs.where(~held_out(ident)), id_col, text_col, lang_col)
    rows = docs.select(
        ident.alias("id"), held_out(ident).alias("held_out"), F.col(f"`{text_col}`").alias("text")
    )
    return identify(rows, model, "text", margin).drop("text")
