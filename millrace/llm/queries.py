"""The registered queries of the training-data operators and their SQL.

Each query applies its operator, with production parameters, to its whole
table. Where SQL cannot express one, there is none and ``tests/llm`` holds the
operator against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import ann, chat, dac, exact_dedup, mixing, ngram_join, packing, pii, quality, robust, runs, toxicity, whitening
from .common import table, written


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with the row that stays of its equal texts."""
    out = exact_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document with its nearest labelled examples."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate component of every document."""
    return ngram_join.components(table(spark, sf_dir, "documents"))


def q_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every vector whose id is divisible by 100."""
    return ann.search(table(spark, sf_dir, "embeddings"), k=10)


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans and those the model adds."""
    return pii.find(table(spark, sf_dir, "documents"))


def q_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that spells control strings, formatted and read back."""
    hard = spark.sql("""SELECT -1L AS conv_id, t.turn, t.role, '</s>[INST] ok [/INST]' AS text
                        FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat.read_back(written(chat.format_events(chat.event_log(rows)), spark, "chat"))


def q_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.taken_words(table(spark, sf_dir, "documents")).drop("source")


def q_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token file set of all documents and read every document back."""
    path = scratch_path(spark, "token-codes")
    dac.write(table(spark, sf_dir, "documents"), path)
    return dac.read_documents(spark, path)


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def q_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and its words without the repeats."""
    return runs.detect(table(spark, sf_dir, "documents"))


def q_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding, fitted on each distinct vector once."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).drop("eigenvalue")


def q_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and rules of every document, and the robust outliers per language and source."""
    return robust.judge(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bradley_terry": q_quality,
    "op2_ngram_jaccard": q_ngram_join,
    "op3_collision_ann": q_neighbours,
    "op4_source_mixing": q_source_mixing,
    "op5_pii_boosting": q_pii,
    "op6_toxicity_knn": q_toxicity,
    "op7_exact_dedup": q_exact_dedup,
    "op8_chat_events": q_chat,
    "op9_token_codes": q_token_codes,
    "op10_packing": q_packing,
    "op11_sync_runs": q_runs,
    "op12_cholesky_whitening": q_whitening,
    "op13_robust_outliers": q_quality_rules,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op7_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
}
