"""Training-corpus pipeline: quality, exact copies, near copies, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet in the shared folder and read back as the next stage's
``docs``.  All stages but the last return the columns of ``documents``, further
columns included.

Defined results: a null or empty text passes the classifier by its score, counts
as the empty text for exact copies, links with nothing as a near copy, has no
tokens to weigh (it stays with its cell's probability), and packs as its closing
id; rows that repeat with their id leave one; a null id stays null; an empty table
gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitflow.llm import exact, mixing, near_text, packing, quality
from visitflow.llm.common import staged
from visitflow.llm.registry import vocabulary

#: A learned classifier has no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the pairwise ranker rejects."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return exact.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 on five-word shingles stays."""
    return near_text.dedup(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample by probabilities raked to the target mix of source, language and topic."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096.  The workers come out of the stages before with what these needed, so they
    remember fewer words than where packing runs alone."""
    return packing.pack_documents(docs, vocabulary(), memo=60_000)


STAGES = [("quality", keep_quality), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = staged(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
