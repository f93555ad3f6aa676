"""From raw documents to a tokenized mix: quality, exact repeats, near repeats, source weights, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the docs of the next one, so a lost executor costs the work of one stage at most. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from numerant.llm.common import table, written
from numerant.llm.exact_dedup import exact_stage
from numerant.llm.mixing import mixing_stage
from numerant.llm.near_dedup import near_stage
from numerant.llm.pieces import pieces_stage
from numerant.llm.quality_classifier import quality_stage

STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("source_mixing", mixing_stage),
    ("sentencepiece", pieces_stage),
]

#: Compression, alignment and sampling are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
