"""The corpus pipeline: raw documents to packed training sequences, one operator per stage.

Every stage works on all that the one before kept and is written below the shared folder before the next one reads
it.  Null texts count as empty, rows that repeat a doc_id are handled as the operators say, and an empty table
goes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunelab.llm import line_dedup, mixing, near_dup, packing, quality
from tunelab.llm.common import stored

#: Weights, epochs and hash seeds have no SQL form in the first and third stage; they are tested by brute force.
ORACLE_SQL = None


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier draws; the others go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that belong to another one."""
    return line_dedup.deduplicated(docs)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8 or more): that of the smallest doc_id.

    SimHash proposes links, which are checked exactly; an exact way finds those beyond its radius.
    """
    return near_dup.representatives(docs)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack_digest(docs)


STAGES = [
    ("quality classifier", stage_quality),
    ("line dedup", stage_lines),
    ("near duplicates", stage_near_duplicates),
    ("mixing", stage_mix),
    ("packing", stage_pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
