"""The corpus pipeline: documents through five text operators, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  All but the last return the columns
of documents; the last returns the packed pieces of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandplan.llm import decontamination, lines, packing, simhash, toxicity
from strandplan.llm.common import checkpoint, table
from strandplan.llm.queries import vocabulary_path
from strandplan.session import ensure_importable


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; labels come from the labels table, for the rows that may be learnt from."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go from the texts; every document stays, with an empty text if no line does."""
    ensure_importable(spark)
    return lines.dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: that of the smallest doc_id."""
    ensure_importable(spark)
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and offset."""
    ensure_importable(spark)
    return packing.pack_documents(docs, vocabulary_path)


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the checkpoint folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
