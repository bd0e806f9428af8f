"""File scans and sinks: listings, CSV (all-text and typed), parquet, text.

Listings use the ``binaryFile`` source without selecting ``content``, so Spark
lists files in parallel and never opens them.
"""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import base_name, extension

CORRUPT = "_corrupt_record"
WRITE_FORMATS = ("parquet", "csv")

# CSV text keeps full microsecond precision (Spark's default timestamp text
# stops at milliseconds and would silently drop the rest)
#: One set for every reader and writer: quotes are doubled as CSV writers do, cells keep their blanks.
CSV_QUOTING = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_TIME_OPTIONS = {
    **CSV_QUOTING,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def norm_uri(c):
    """One spelling for local URIs (``file:/x`` and ``file:///x``)."""
    return F.regexp_replace(c, r"^file:/+", "file:///")


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme and authority that Spark gives it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(at).toString()


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """One row per file under ``path``: ``path, file_name, length,
    modification_time``. ``glob`` filters base names (case-sensitive, so
    ``*.csv`` skips ``x.csv.done``). A missing folder is an error.

    Spark's file scans skip zero-byte files, so the rows come from the file
    index (the listing the driver holds for any scan, empty files included)
    and the sizes and times from the ``binaryFile`` metadata, which never
    opens the files. ``recursive=False`` keeps only files directly in ``path``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    listing = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string")
    listing = listing.select(norm_uri(F.col("path")).alias("path"))
    listing = listing.withColumn("relative_path", relative_to(F.col("path"), path))
    if not recursive:
        listing = listing.filter(~F.col("relative_path").contains("/"))
    meta = files.select(norm_uri(F.col("path")).alias("path"), "length",
                        F.col("modificationTime").alias("modification_time"))
    return listing.join(meta, "path", "left").select(
        "path", "relative_path", base_name("path").alias("file_name"),
        F.coalesce("length", F.lit(0)).alias("length"), "modification_time")


def list_tree(spark: SparkSession, path: str) -> DataFrame:
    """Every file under ``path``, hidden names (``_x``, ``.x``) and their folders included, as ``find``
    sees them: ``path, file_name, length``. The driver lists the first level only; its
    folders are dealt to tasks, which walk them. ``path`` must be of a file system that the
    workers' Arrow reaches (local and shared disks, HDFS, S3)."""
    from pyarrow import fs

    root = re.sub(r"^s3a:", "s3:", path.rstrip("/"))
    store, base = fs.FileSystem.from_uri(root if re.match(r"^[a-z0-9]+:/", root) else f"file://{os.path.abspath(root)}")
    first = store.get_file_info(fs.FileSelector(base))
    schema = "path string, file_name string, length long"
    files = [(f.path, f.base_name, f.size) for f in first if f.type == fs.FileType.File]
    folders = sorted(f.path for f in first if f.type == fs.FileType.Directory)
    out = spark.createDataFrame(files, schema)
    if not folders:
        return out

    def walk(batches):
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                todo = [folder]
                while todo:  # one folder's entries at a time
                    found = store.get_file_info(fs.FileSelector(todo.pop()))
                    todo += [f.path for f in found if f.type == fs.FileType.Directory]
                    own = [f for f in found if f.type == fs.FileType.File]
                    yield pa.RecordBatch.from_arrays([pa.array([f.path for f in own], pa.string()), pa.array([f.base_name for f in own], pa.string()),
                                                      pa.array([f.size for f in own], pa.int64())], names=["path", "file_name", "length"])

    dealt = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(max(1, min(len(folders), 1000)))
    return out.unionByName(dealt.mapInArrow(walk, schema))


def relative_to(path: "F.Column", root: str):
    """The part of a listed file path below ``root`` (as given by the user:
    absolute, relative, or a URI)."""
    core = re.sub(r"^file:/*", "/", root.rstrip("/")) if root.startswith("file:") else root.rstrip("/")
    return F.regexp_extract(path, re.escape(core) + "/(.+)$", 1)


def count_files(spark: SparkSession, path: str, ext: str | None = None, *, hidden: bool = False) -> DataFrame:
    """Files per extension, recursively, extension compared case-insensitively.

    Without ``ext`` every extension is counted (``ext`` = '' for none); with it,
    one row for that extension (count 0 when there is none). ``hidden`` counts names that
    begin with ``_`` or ``.`` too, and lists by tasks (:func:`list_tree`)."""
    files = (list_tree(spark, path) if hidden else list_files(spark, path)).select(extension("path").alias("ext"))
    if ext is None:
        return files.groupBy("ext").agg(F.count(F.lit(1)).alias("files"))
    wanted = ext.lower().lstrip(".")
    return files.agg(F.count(F.when(F.col("ext") == wanted, 1)).alias("files")) \
        .select(F.lit(wanted).alias("ext"), "files")


def csv_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names from the header line (reads only the first line)."""
    return spark.read.options(**CSV_QUOTING).option("header", True).option("sep", sep).csv(path).columns


def read_csv_text(spark: SparkSession, path: str, *, sep: str = ",",
                  columns: Sequence[str] | None = None, header: bool = True,
                  empty_as_text: bool = True, multiline: bool = True,
                  keep_corrupt: bool = False) -> DataFrame:
    """CSV, every column as text; column names from the header row, or
    ``columns`` for files without one.

    A present-but-empty cell is ``''`` (Spark would give null) on well-formed
    rows; a short or long row is kept with nulls for its missing cells and
    flagged by ``_corrupt_record``. Quoted line breaks are part of a cell;
    ``multiline=False`` splits large files over tasks where none occur.
    """
    if columns is None:
        if not header:
            raise ValueError("columns are required for files without a header row")
        columns = csv_header(spark, path, sep)
    columns = list(columns)
    schema = StructType([StructField(c, StringType()) for c in columns] +
                        [StructField(CORRUPT, StringType())])
    raw = (spark.read.schema(schema).options(**CSV_QUOTING).option("header", header).option("sep", sep)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("multiLine", multiline).csv(path))
    well_formed = F.col(CORRUPT).isNull()
    cols = [(F.when(well_formed, F.coalesce(F.col(f"`{c}`"), F.lit(""))).otherwise(F.col(f"`{c}`"))
             if empty_as_text else F.col(f"`{c}`")).alias(c) for c in columns]
    if keep_corrupt:
        cols.append(F.col(CORRUPT))
    return raw.select(*cols)


def read_csv_typed(spark: SparkSession, path: str, *, sep: str = ",", header: bool = True,
                   multiline: bool = True, schema: StructType | str | None = None) -> DataFrame:
    """CSV with inferred (or given) types. Without a header the columns are
    positional (``_c0``, ``_c1``...). Inference reads the whole input. With quoted line
    breaks (``multiline``) a file is one task; ``plans.loads.load_csv_by_lattice`` is not."""
    reader = spark.read.options(**CSV_QUOTING).option("header", header).option("sep", sep).option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "overwrite",
              sep: str = ",") -> None:
    """CSV with a header line, UTF-8, timestamps to the microsecond."""
    (df.write.mode(mode).options(**CSV_TIME_OPTIONS).option("header", header).option("sep", sep)
     .option("encoding", "UTF-8").csv(path))


def write_files(df: DataFrame, path: str, fmt: str = "parquet", *, mode: str = "overwrite",
                partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> None:
    """Write parquet or CSV to any Spark URI (local, HDFS, ``s3a://``)."""
    fmt = fmt.lower()
    if fmt not in WRITE_FORMATS:
        raise ValueError(f"unsupported file format {fmt!r}; use one of {WRITE_FORMATS}")
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).options(**CSV_TIME_OPTIONS)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def copy_day(spark: SparkSession, source_path: str, target_path: str, day: str, *,
             fmt: str = "parquet", partition_col: str = "ingest_date") -> None:
    """Copy one day's folder into ``target_path/<partition_col>=<day>``,
    replacing that day only. CSV is read by header, cells as text (quotes, blanks and
    line breaks stay); rows that do not fit their header raise."""
    if fmt == "csv":
        from .csvsplit import read_csv_by_header

        src, rejects = read_csv_by_header(spark, source_path)
        bad = rejects.first()
        if bad is not None:
            raise ValueError(f"{bad['file']} has rows that do not fit ({bad['reason']})")
    else:
        src = spark.read.format(fmt).load(source_path)
    out = src.withColumn(partition_col, F.to_date(F.lit(day)))
    options = CSV_TIME_OPTIONS if fmt == "csv" else {}
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
     .partitionBy(partition_col).format(fmt).option("header", True).save(target_path))
