"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes what the one before kept, stored as Parquet in the shared folder. No SQL can
express the learned and hashed stages, so ORACLE_SQL is None; tests/llm checks every stage
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbflow.llm import decontaminate, fuzzy_dedup, language, packing, secrets
from ebbflow.llm.common import ship, table
from ebbflow.session import settled

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3
CAPACITY = 1024


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null, have no letter, or are of no language it knows with a
    probability of at least LEAST_SCORE. It learns from the rows whose lang is not null."""
    ship(spark)
    network = language.train(docs.select("doc_id", "text", "lang"))
    judged = language.identify(docs.select(COLUMNS), network)
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return judged.where(kept).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that the near-duplicate operator finds, with the shingles
    and the bits of its contract: the least doc_id, a null last. Null, empty and blank texts have
    fingerprint 0 and are a group like any other; repeated rows leave one; no rows give none."""
    ship(spark)
    return fuzzy_dedup.one_of_each(docs.select(COLUMNS))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a passage of the benchmark. A null or empty text holds none and
    stays, and so does every row if the benchmark is empty; repeated rows go or stay together."""
    return decontaminate.without_leaks(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents and masks the secrets in their texts; n_chars follows the text. Null and
    empty texts and repeated rows stay as they are; no rows give none."""
    docs = docs.select(COLUMNS)
    found = secrets.find_secrets(docs, secrets.train(docs))
    masked = found.withColumn("text", secrets.redacted(F.col("text"), F.col("secrets")))
    changed = F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", changed).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts with their place in sequences of at most CAPACITY tokens. A null or
    empty text is its end id alone; repeated rows are packed each; no rows give none."""
    ship(spark)
    return packing.pack(docs, CAPACITY)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
