"""From raw documents to token ids: each stage works on what the one before has kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; it is written as Parquet in the shared folder and reread as the next
one's documents. All but the last return the columns of ``documents``. No stage has a twin in SQL: hashes, learned weights and
merges are beyond it, so tests hold each against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.llm import bpe, jaccard, langid, mixing, pii
from postsieve.session import cut_lineage

LEAST_SURE = 0.3  # language probability below which a document is rejected: short clean texts stay


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: those without letters, and those of no likely language, go."""
    model = langid.train(docs, F.coalesce(langid.bucket_of("doc_id", 4) != 2, F.lit(False)))
    told = langid.identify(docs.select(F.struct("*").alias("row"), "text"), model, carry=["row"])
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SURE)).select("row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: sets of five-word shingles with a similarity of 0.8 or more."""
    return jaccard.one_of_each_group(docs, n=5, num=80, den=100)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with addresses, numbers and cards replaced by their kind."""
    return pii.redact(docs, pii.fit(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of training, each as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and what they decode to: doc_id, n_tokens, ids as little-endian unsigned 32-bit integers, text."""
    coded = bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return coded.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", without_copies),
    ("pii", without_personal_data),
    ("mixing", mixed),
    ("bpe", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
