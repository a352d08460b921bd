"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mesada.llm.words import blocks, text_bytes

AT_ONCE = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the one set in the context.

    A fresh local folder stands in where neither is set, as in tests, but only on one machine:
    on a cluster, executors would not see each other's files, so that is refused.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        found = spark.sparkContext.getCheckpointDir()
    if found is None and not _one_machine(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return found or tempfile.mkdtemp(prefix="checkpoint-")


def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: rows are written to the shared folder and read back from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as set it apart from df's columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def map_text(
    df: DataFrame,
    text_col: str,
    work: Callable[[pa.Array], list],
    fields: str,
    drop_text: bool = False,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """df with new columns: work gets a batch's texts (null as empty) and returns their values.

    ``fields`` is a DDL list of the new columns; the caller keeps them apart from df's columns.
    A batch is worked on in runs of whole texts of at most at_once bytes, or a single text.
    """
    new = T.StructType.fromDDL(fields)
    kept = [f for f in df.schema.fields if not (drop_text and f.name == text_col)]
    names = [f.name for f in kept] + new.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            column = pc.fill_null(whole.column(whole.schema.get_field_index(text_col)), "")
            for first, last in blocks(text_bytes(column)[1], at_once):
                batch = whole.slice(first, last - first)
                made = work(column.slice(first, last - first))
                held = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    held + [a if isinstance(a, pa.Array) else pa.array(a) for a in made],
                    names=names,
                )

    return df.mapInArrow(run, T.StructType([*kept, *new.fields]))


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; then freed memory goes back to the system, as workers outlive their tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):  # only in GNU's C library
        ctypes.CDLL(None).malloc_trim(0)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only what an operator reads, under names of its own; a null text is empty."""
    return df.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
