"""Exact duplicates through a persistent digest index.

The index is a table bucketed and sorted by digest that outlives a run. A new
batch is reduced to one row per digest (partial aggregation runs before the
shuffle, so a text held by a third of all rows costs one row per task), the
digests already known are removed by a sort-merge anti-join that reads the
bucketed side without shuffling it, and the rest is appended. Texts never
move: only 32-byte digests do.

Defined cases: null text counts as empty; only A-Z are lower-cased; of equal
texts the largest doc_id stays (a null doc_id loses to any other); rows that
repeat one doc_id with one text are all marked kept and are reduced to one row
by :func:`drop_duplicates`; an empty table gives an empty result. A text
already in the index keeps the doc_id the index holds, so adding a batch twice
changes nothing.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..session import scratch_path, unique_name
from .common import doc_texts, written


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; the faster built-in serves texts that are all ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the 32-byte SHA-256 of each normalised text."""
    return doc_texts(docs).select(
        "doc_id", F.unhex(F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)).alias("digest"))


class DigestIndex:
    """Digests seen so far, as a table bucketed and sorted by digest."""

    def __init__(self, spark: SparkSession, table: str, *, buckets: int, path: str | None = None):
        self.spark, self.table, self.buckets, self.path = spark, table, buckets, path

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """Add groups (digest, keep_id) that the index lacks, in its bucketing."""
        new = groups.select("digest", "keep_id")
        if self.exists():
            new = new.join(self.rows().hint("merge"), "digest", "left_anti")
        new = new.repartition(self.buckets, "digest")
        writer = new.write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").mode("append")
        if self.path:
            writer = writer.option("path", self.path)
        writer.saveAsTable(self.table)


def index_buckets(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Per document: ``doc_id, keep_id, group_size, kept, digest``.

    Adds the batch to ``index`` (a fresh one by default) and reads every
    decision back from it. ``group_size`` counts the rows of this batch."""
    spark = docs.sparkSession
    if index is None:
        index = DigestIndex(spark, unique_name("digest_index"), buckets=index_buckets(spark),
                            path=scratch_path(spark, "digest-index"))
    hashed = written(digests(docs), spark, "digests")
    groups = written(hashed.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                                  F.count(F.lit(1)).alias("group_size")), spark, "digest-groups")
    index.append(groups)
    decided = written(groups.drop("keep_id").join(index.rows().hint("merge"), "digest"), spark, "digest-decided")
    # both sides arrive by shuffle, so adaptive execution can split a hot digest
    return hashed.join(decided, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def drop_duplicates(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Dropped rows go by
    a size-checked broadcast of (doc_id, digest); only rows that repeat a kept
    pair are compared again."""
    spark = docs.sparkSession
    decisions = written(deduplicate(docs, index), spark, "dedup-decisions")
    key, digest = "__dedup_id", "__dedup_digest"
    pairs = decisions.groupBy(F.col("doc_id").alias(key), F.col("digest").alias(digest)).agg(
        F.first("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    odd = written(pairs.where("not kept or n > 1"), spark, "dedup-odd")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    hashed = docs.withColumn(digest, F.unhex(F.sha2(ascii_lower(text).cast("binary"), 256)))

    def having(which: str, how: str, left: DataFrame) -> DataFrame:
        side = broadcast_if_small(odd.where(which).select(key, digest))
        return left.join(side, (left[digest] == side[digest]) & left["doc_id"].cast("long").eqNullSafe(side[key]), how)

    out = having("not kept", "left_anti", hashed)
    if odd.where("kept").isEmpty():
        return out.select(docs.columns)
    once = having("kept", "left_anti", out).select(docs.columns)
    return once.unionByName(having("kept", "left_semi", out).dropDuplicates(["doc_id", digest]).select(docs.columns))
