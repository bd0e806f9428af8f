"""Reconciliation of two datasets of named files: presence per side and
content equality ignoring white space and blank lines (``diff -wB``).

Each side is one row per file (``name``, ``text``). Content is normalised per
row -- split into lines, every white-space character removed, empty lines
dropped -- and reduced to a fingerprint (SHA-256 of the normalised lines), so
the join between the sides carries 32 bytes per file, not the text. Whole
texts are processed; nothing is truncated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import drop_c_space

YES, NO, NA = "Y", "N", "N/A"


def normalised_lines(text: Column) -> Column:
    """Lines without any white space, empty lines removed (array<string>)."""
    lines = F.split(text, "\n", -1)
    stripped = F.transform(lines, lambda line: drop_c_space(line))
    return F.filter(stripped, lambda line: line != "")


def normalised_text(text: Column) -> Column:
    """The normalised lines joined by newlines, computed on the whole text
    without a per-line lambda: drop every white-space character except the
    line breaks, collapse runs of line breaks (empty lines), trim them at both
    ends. Equal to ``array_join(normalised_lines(text), '\\n')``."""
    no_space = F.regexp_replace(text, r"[ \t\x0B\f\r]", "")
    return F.btrim(F.regexp_replace(no_space, r"\n+", "\n"), F.lit("\n"))


def content_fingerprint(text: Column) -> Column:
    """SHA-256 of the normalised lines joined by newlines."""
    return F.sha2(normalised_text(text), 256)


def presence_matrix(left: DataFrame, right: DataFrame, name_col: str = "file_name") -> DataFrame:
    """``file_name, in_folder1, in_folder2`` (Y/N) over the union of both name sets."""
    a = left.select(F.col(name_col).alias("file_name")).distinct().withColumn("__a", F.lit(True))
    b = right.select(F.col(name_col).alias("file_name")).distinct().withColumn("__b", F.lit(True))
    both = a.join(b, "file_name", "full_outer")
    return both.select("file_name",
                       F.when(F.col("__a"), YES).otherwise(NO).alias("in_folder1"),
                       F.when(F.col("__b"), YES).otherwise(NO).alias("in_folder2"))


def compare_datasets(left: DataFrame, right: DataFrame, name_col: str = "file_name",
                     text_col: str = "text") -> DataFrame:
    """``file_name, in_folder1, in_folder2, content_match``; ``content_match`` is
    Y/N for names on both sides and N/A otherwise.

    A null text matches only a null text. Rows that share a name match when both
    sides hold the same texts, in any order: each name is reduced, map-side first,
    to its count, least and greatest fingerprint and a sum of hashes."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        prints = df.select(F.col(name_col).alias("file_name"),
                           F.coalesce(content_fingerprint(F.col(text_col)).cast("string"), F.lit("")).alias("fp"))
        return prints.groupBy("file_name").agg(F.struct(
            F.count(F.lit(1)), F.min("fp"), F.max("fp"), F.sum(F.xxhash64("fp").cast("decimal(20,0)"))).alias(tag))

    both = side(left, "__fa").join(side(right, "__fb"), "file_name", "full_outer")
    in_a = F.col("__fa").isNotNull()
    in_b = F.col("__fb").isNotNull()
    match = F.when(in_a & in_b, F.when(F.col("__fa") == F.col("__fb"), YES).otherwise(NO)).otherwise(NA)
    return both.select("file_name",
                       F.when(in_a, YES).otherwise(NO).alias("in_folder1"),
                       F.when(in_b, YES).otherwise(NO).alias("in_folder2"),
                       match.alias("content_match"))


def line_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, k, h`` for the files directly under ``path``: ``h`` is the
    SHA-256 of the k-th non-empty line (white space removed) of the file.

    Files of any size: positions are taken after the filter in the scan stage,
    numbered in file order per input split, and made relative to each file's
    first kept line through a one-row-per-file table; no file is gathered."""
    from ..plans.joins import broadcast_if_small
    from .chunks import with_split_order_index

    from ..sources.files import relative_to

    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    norm = raw.select(relative_to(F.col("_metadata.file_path"), path).alias("file_name"),
                      F.col("_metadata.file_path").alias("__file"),
                      F.col("_metadata.file_block_start").alias("__block"),
                      drop_c_space(F.col("value")).alias("__norm"))
    kept = norm.filter(F.col("__norm") != "").select("*", F.monotonically_increasing_id().alias("__pos"))
    ranked = with_split_order_index(kept, ["__file", "__block"], "__pos", "__g")
    first = ranked.groupBy("__file").agg(F.min("__g").alias("__g0"))
    lines = ranked.join(broadcast_if_small(first, cache=True), "__file")
    return lines.select("file_name", (F.col("__g") - F.col("__g0") + 1).alias("k"),
                        F.sha2(F.col("__norm"), 256).alias("h"))


def compare_folders_by_line(spark: SparkSession, folder1: str, folder2: str) -> DataFrame:
    """The folder-comparison report with line-level work only (for files too
    large to be one row): presence from the file listings, content equality
    from a join of the two sides' line hashes on ``(file, k)`` and a per-file
    AND (combined map-side)."""
    from ..sources.files import list_files

    names = presence_matrix(list_files(spark, folder1).select(F.col("relative_path").alias("file_name")),
                            list_files(spark, folder2).select(F.col("relative_path").alias("file_name")))
    a = line_hashes(spark, folder1).withColumnRenamed("h", "__ha")
    b = line_hashes(spark, folder2).withColumnRenamed("h", "__hb")
    pairs = a.join(b, ["file_name", "k"], "full_outer")
    same = F.coalesce(F.col("__ha") == F.col("__hb"), F.lit(False))
    per_file = pairs.groupBy("file_name").agg(F.min(same).alias("__all_same"))
    both = (F.col("in_folder1") == YES) & (F.col("in_folder2") == YES)
    match = F.when(both, F.when(F.coalesce("__all_same", F.lit(True)), YES).otherwise(NO)).otherwise(NA)
    return names.join(per_file, "file_name", "left").select(
        "file_name", "in_folder1", "in_folder2", match.alias("content_match"))


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, text`` for every file under ``path`` (one row per file,
    named by its path below ``path``; an empty file has text '')."""
    from ..sources.files import list_files, relative_to

    docs = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    texts = docs.select(relative_to(F.col("_metadata.file_path"), path).alias("file_name"),
                        F.col("value").alias("text"))
    names = list_files(spark, path).select(F.col("relative_path").alias("file_name"))
    return names.join(texts, "file_name", "left").select(
        "file_name", F.coalesce("text", F.lit("")).alias("text"))


def compare_folders(spark: SparkSession, folder1: str, folder2: str, *, by_line: bool = False) -> DataFrame:
    """The folder-comparison report for two folders of text files: one row
    per file (fast for ordinary files), or ``by_line`` for files of any size."""
    if by_line:
        return compare_folders_by_line(spark, folder1, folder2)
    return compare_datasets(read_folder(spark, folder1), read_folder(spark, folder2))
