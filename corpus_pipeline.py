"""A training corpus in five stages: toxic documents go, exact copies go, near
copies go, sources are mixed to their targets, and the mix is packed.

Each stage reads what the one before it kept; ``run`` writes every stage's rows
to the shared folder and reads them back, so a lost executor never costs more
than one stage. Before each stage executors give back what the one before it left
in memory, so it does not add up from stage to stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from millrace.llm.common import bounded_batches, start_afresh, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity cut, judged by their nearest labelled examples."""
    start_afresh(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    start_afresh(spark)
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle similarity of 0.75 the one with the smallest doc_id."""
    start_afresh(spark)
    bounded_batches(spark)
    return ngram_join.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    start_afresh(spark)
    return mixing.repeated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; the documents' text stays behind."""
    start_afresh(spark)
    bounded_batches(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned scores and tokenizers are beyond SQL; tests/llm hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), spark, f"stage-{name}")
    return docs
