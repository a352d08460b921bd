"""A corpus pipeline over ``documents``: each stage writes its rows, the next one reads them.

The stages reject texts by quality rules, keep one document of each group of SimHash
near-duplicates, drop documents with passages of the benchmark, mask personal data, and drop
nothing more in the last, which returns the token ids of what is left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mesada.llm import stages
from mesada.llm.common import shared_dir

STAGES = [
    ("quality rules", stages.quality_stage),
    ("simhash near-dedup", stages.near_dedup_stage),
    ("decontamination", stages.decontaminate_stage),
    ("pii", stages.pii_stage),
    ("sentencepiece", stages.encode_stage),
]

#: No SQL: SimHash, edit distances and the tokenizer cannot be written in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
