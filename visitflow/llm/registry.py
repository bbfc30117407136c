"""Queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import alignment, exact, merkle, mixing, near_text, near_vectors, packing, quality, scoring, sharding, substrings, urls, warc

#: Vocabulary of the packing query.
VOCABULARY = "word_bpe_49k.json"
#: Vocabularies of the alignment query.
BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_masked_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_documents(_table(spark, sf_dir, "documents"))


def op2_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.groups(_table(spark, sf_dir, "documents"))


def op3_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, sf_dir, "documents"))


def op5_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.groups(_table(spark, sf_dir, "embeddings"))


def op6_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents")).drop("runs")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(_table(spark, sf_dir, "documents"))


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolve_pages(_table(spark, sf_dir, "pages"))


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op10_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary())


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_documents(_table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_VOCABULARY))


def op13_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


QUERIES = {f.__name__: f for f in (
    op1_masked_likelihood, op2_chosen_path, op3_bradley_terry, op4_source_mixing, op5_sorted_projections, op6_deep_shallow, op7_exact_dedup, op8_revisits, op9_virtual_slots, op10_vector_packing,
    op11_merkle_manifest, op12_tokenizer_alignment, op13_redirect_filter)}
ORACLES = {"op4_source_mixing": mixing.ORACLE, "op7_exact_dedup": exact.ORACLE, "op8_revisits": warc.ORACLE,
           "op11_merkle_manifest": merkle.ORACLE, "op13_redirect_filter": urls.ORACLE}
