"""Export a table into N evenly sized, serially named CSV chunks, resumable.

One range sort numbers the rows (no per-page re-sort, no driver fetch); each
row gets its chunk's file name; a single partitioned write emits all chunks in
parallel. A chunk is the folder ``file_name=YYYYMMDD-NN.csv`` holding one or
more part files in order, so a chunk of any size is written by many tasks.
``single_file=True`` gathers each chunk into one file (small exports only).

Resume: chunks whose folder already exists are left out of the write; the
chunk numbering is still computed over every row, so the remaining chunks
keep their positions. Chunks are written with dynamic partition overwrite:
writing a chunk again (``only_chunks``, or a retry) replaces it, never
appends duplicates. A chunk folder appears only when its job commits (Spark's
default commit protocol); on object stores use a committer with an atomic
job commit so an interrupted commit cannot leave a partial chunk behind.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.dates import as_date
from ..operators.chunks import assign_chunks, chunk_file_name
from .files import CSV_TIME_OPTIONS, list_files

FILE_COL = "file_name"
DEFAULT_CHUNKS = 15


def existing_chunks(df: DataFrame, out_dir: str) -> DataFrame:
    """File names of chunks already present under ``out_dir`` (empty if none)."""
    spark = df.sparkSession
    try:
        files = list_files(spark, out_dir)
    except AnalysisException:
        return spark.createDataFrame([], f"{FILE_COL} string")
    name = F.regexp_extract("path", rf"/{FILE_COL}=([^/]+)/[^/]+$", 1)
    return files.select(name.alias(FILE_COL)).filter(F.col(FILE_COL) != "").distinct()


def export_chunks(df: DataFrame, n: int, out_dir: str, order_by, run_date: str | _dt.date | None = None, *,
                  resume: bool = False, only_chunks=None, single_file: bool = False,
                  header: bool = True, default_if_nonpositive: int | None = None,
                  naming: str = "dated") -> DataFrame:
    """Write ``df`` as ``n`` ceil-sized chunks named ``YYYYMMDD-NN.csv`` under
    ``out_dir`` and return the planned manifest (``file_name, rows``) of every
    chunk, computed from the row count -- the export is not read back (use
    :func:`manifest` to verify what is on disk).

    Chunks of the same run (same date, or ``part_N``) that the plan does not name,
    left by an export into more chunks, raise before anything is written.
    ``n <= 0`` raises unless ``default_if_nonpositive`` is given (e.g. 15).
    ``only_chunks`` writes just those chunk numbers (a retry of a few chunks).
    ``naming="part"`` names chunks ``part_N.csv`` (no run date needed)."""
    chunked = assign_chunks(df, n, order_by, "__chunk", index_col="__row",
                            default_if_nonpositive=default_if_nonpositive)
    day = as_date(run_date) if run_date is not None else F.lit(None).cast("date")
    chunked = chunked.withColumn(FILE_COL, chunk_file_name(day, F.col("__chunk"), naming=naming))
    planned = planned_manifest(df, n, run_date, default_if_nonpositive, naming=naming)
    _refuse_stale(planned, existing_chunks(df, out_dir), run_date, naming, out_dir)
    if only_chunks is not None:
        chunked = chunked.filter(F.col("__chunk").isin(list(only_chunks)))
    if resume:
        done = existing_chunks(df, out_dir)
        # at most one row per chunk: a bounded side
        chunked = chunked.join(F.broadcast(done), FILE_COL, "left_anti")
    if single_file:
        chunked = chunked.repartition(FILE_COL)
    # sorted by (file, row): the writer's required order is already met, rows
    # stay in export order inside every file
    out = chunked.sortWithinPartitions(FILE_COL, "__row").select(*df.columns, FILE_COL)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**CSV_TIME_OPTIONS)
     .option("header", header).partitionBy(FILE_COL).csv(out_dir))
    return planned


def _refuse_stale(planned: DataFrame, present: DataFrame, run_date, naming: str, out_dir: str) -> None:
    """Raise when ``present`` holds chunks of this run that ``planned`` does not name."""
    one = present.sparkSession.range(1)
    day = as_date(run_date) if run_date is not None else F.lit(None).cast("date")
    stem = one.select(F.regexp_replace(chunk_file_name(day, F.lit(1), naming=naming), r"0*1\.csv$", "").alias("stem"))
    of_run = present.join(F.broadcast(stem), F.col(FILE_COL).startswith(F.col("stem"))).drop("stem")
    stale = of_run.join(planned, FILE_COL, "left_anti").orderBy(FILE_COL).first()
    if stale is not None:
        raise ValueError(f"{out_dir} holds {stale[0]} of an export into more chunks; remove it or choose another folder")


def planned_manifest(df: DataFrame, n: int, run_date, default_if_nonpositive: int | None = None, *,
                     naming: str = "dated") -> DataFrame:
    """``file_name, rows`` of every chunk from arithmetic on the row count:
    ``ceil(N/n)`` rows per chunk, the last one shorter (one small job)."""
    from ..operators.chunks import check_count

    n = check_count(n, "number of chunks", default_if_nonpositive)
    total = df.agg(F.count(F.lit(1)).alias("__n"))
    size = F.ceil(F.col("__n") / F.lit(n))
    per = total.select(F.explode(F.sequence(F.lit(1), F.ceil(F.col("__n") / size).cast("int"))).alias("c"),
                       "__n", size.alias("__size"))
    rows = F.least(F.col("__size"), F.col("__n") - (F.col("c") - 1) * F.col("__size"))
    day = as_date(run_date) if run_date is not None else F.lit(None).cast("date")
    return per.filter(F.col("__n") > 0).select(
        chunk_file_name(day, F.col("c"), naming=naming).alias(FILE_COL), rows.cast("long").alias("rows"))


def manifest(df: DataFrame, out_dir: str, *, header: bool = True) -> DataFrame:
    """Rows per chunk as read back from ``out_dir``."""
    spark = df.sparkSession
    schema = ", ".join(f"`{c}` string" for c in df.columns) + f", {FILE_COL} string"
    back = spark.read.schema(schema).options(**CSV_TIME_OPTIONS).option("header", header).option("multiLine", True).csv(out_dir)
    return back.groupBy(FILE_COL).agg(F.count(F.lit(1)).alias("rows"))
