"""A corpus made ready for training, stage by stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the next docs,
which ``run`` writes as a Parquet table in the shared folder and reads again.

All stages take null and empty texts as texts without words, tokens or personal data, keep null keys, treat repeated rows each on its
own (near duplicates keep one of them), take long texts whole, keep columns of any name as they are, and return no rows
for no rows. The docstrings of the operators that they call say more.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cobasket.llm import mixing, packing, personal_data, simhash, toxicity
from cobasket.llm.names import unused
from cobasket.llm.storage import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.3."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that SimHash links by at most three bits of three-word shingles."""
    return simhash.keep_one_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by their kind, and their lengths brought up to date."""
    clean = personal_data.redact(docs, personal_data.train(docs))
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out at random so that sources get their target weights."""
    helpers = unused(docs, "copy"), unused(docs, "shuffle_key")
    return mixing.mix(docs, copy=helpers[0], shuffle_key=helpers[1]).drop(*helpers)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained score and fingerprints have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
