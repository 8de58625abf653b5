"""The corpus pipeline: language ID, exact and near deduplication, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run`` writes each
result as Parquet in the shared folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txmon.llm import exact_dedup, language_id, mixing, near_dedup, packing
from txmon.llm.common import read, staged

STAGES = [
    ("language_id", language_id.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_dedup", near_dedup.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]

#: Classifiers, minhashes and the tokenizer have no SQL form; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
