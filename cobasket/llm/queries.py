"""The operators of this subpackage as queries ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cobasket.llm import alignment, bloom_sketch, filter_audit, minhash, mixing, personal_data, pivot_search, sharding, toxicity, warc
from cobasket.llm.packing import pack_documents
from cobasket.llm.simhash import near_duplicates
from cobasket.llm.token_counts import count_tokens

WORD_BPE, BYTE_BPE, PIECE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bloom_sketch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_sketch.with_edits(_table(spark, sf_dir, "documents"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return personal_data.find(documents, personal_data.train(documents))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, _table(spark, sf_dir, "labels")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op6_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _table(spark, sf_dir, "pages"))


def op8_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op9_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(_table(spark, sf_dir, "embeddings"))


def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bloom_sketch_fingerprints,
        op2_personal_data,
        op3_toxicity,
        op4_token_counts,
        op5_poisson_mixing,
        op6_kd_tree_shards,
        op7_warc_round_trip,
        op8_harmonic_packing,
        op9_pivot_search,
        op10_simhash_components,
        op11_filter_audit,
        op12_minhash_components,
        op13_token_alignment,
    )
}
