"""Daily partition ETL: filter one day (or a run of days), join a dimension,
overwrite exactly those date partitions, and compute the high-water date.

The plan is declared once and Catalyst does the rest: the day predicate is a
plain range on the fact column (pushed into the parquet scan), only the named
columns are read, the dimension is broadcast when its row count is proven
small and otherwise joined by shuffle, and the write replaces only the
partitions present in the result (dynamic partition overwrite).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date, days_between, in_days, on_day
from ..functions.text import col_of
from ..sources.snapshots import Folder, SnapshotTable
from .joins import DEFAULT_BROADCAST_ROWS, broadcast_if_small

ColumnMap = Mapping[str, "str | Column"]


def _field(df: DataFrame, name: str):
    return next((f for f in df.schema.fields if f.name == name), None)


def _select(mapping: ColumnMap) -> list[Column]:
    return [col_of(expr).alias(name) for name, expr in mapping.items()]


def _join_dim(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
              dim_select: ColumnMap, broadcast_rows: int) -> DataFrame:
    d = dim.select(F.col(dim_key).alias("__dim_key"), *_select(dim_select))
    d = broadcast_if_small(d, broadcast_rows)
    # inner join: facts without a dimension row are dropped, as in the SQL job
    return facts.join(d, facts["__fact_key"] == d["__dim_key"], "inner")


def daily_etl(fact: DataFrame, dim: DataFrame, day: str | _dt.date, *,
              fact_key: str, dim_key: str, date_col: str,
              fact_select: ColumnMap, dim_select: ColumnMap,
              filters: Mapping[str, object] | None = None,
              out_date_col: str = "sale_date",
              broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One day's rows: ``filters`` (column = constant, ANDed) and the day
    predicate on ``date_col``, projected, joined to ``dim`` on the key, with
    the day attached as ``out_date_col`` (a DATE)."""
    cond = on_day(date_col, day, _field(fact, date_col))
    for name, value in (filters or {}).items():
        cond = cond & (F.col(name) == F.lit(value))
    facts = fact.filter(cond).select(F.col(fact_key).alias("__fact_key"), *_select(fact_select))
    joined = _join_dim(facts, dim, fact_key, dim_key, dim_select, broadcast_rows)
    return joined.select(*fact_select.keys(), *dim_select.keys(),
                         as_date(day).alias(out_date_col))


def backfill_frame(fact: DataFrame, dim: DataFrame, first_day, last_day, *,
                   fact_key: str, dim_key: str, date_col: str,
                   fact_select: ColumnMap, dim_select: ColumnMap,
                   filters: Mapping[str, object] | None = None,
                   out_date_col: str = "sale_date",
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """All days of ``[first_day, last_day]`` in one pass; same rows as running
    :func:`daily_etl` once per day and concatenating."""
    cond = in_days(date_col, first_day, last_day, _field(fact, date_col))
    for name, value in (filters or {}).items():
        cond = cond & (F.col(name) == F.lit(value))
    facts = fact.filter(cond).select(F.col(fact_key).alias("__fact_key"),
                                     F.to_date(F.col(date_col)).alias(out_date_col),
                                     *_select(fact_select))
    joined = _join_dim(facts, dim, fact_key, dim_key, dim_select, broadcast_rows)
    return joined.select(*fact_select.keys(), *dim_select.keys(), out_date_col)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str],
                         fmt: str = "parquet", options: Mapping[str, str] | None = None) -> None:
    """Write ``df`` under ``path`` replacing only the partitions it contains.

    ``rebalance`` lets AQE size the write tasks from the real data: small
    partitions are packed together and a hot partition value (one day holding a
    third of the rows) is split over several tasks instead of one.
    """
    writer = (df.hint("rebalance", *partition_cols).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic")
              .partitionBy(*partition_cols).format(fmt))
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    writer.save(path)


def latest_date(df: DataFrame, date_col: str, default: str | _dt.date,
                alias: str = "latest_date") -> DataFrame:
    """One row: the maximum day of ``date_col``, or ``default`` when there is none."""
    return df.agg(F.coalesce(F.max(F.to_date(F.col(date_col))), as_date(default)).alias(alias))


def pending_days(latest: DataFrame, today: str | _dt.date | Column, *,
                 latest_col: str = "latest_date", lookback_days: int = 0,
                 alias: str = "day") -> DataFrame:
    """Days still to load: ``latest + 1 - lookback_days`` .. ``today`` inclusive.

    ``latest`` is the one-row result of :func:`latest_date`; nothing is returned
    when the target is up to date. ``lookback_days`` re-loads recent days that
    may have been incomplete when first loaded (0 keeps the plain high-water rule).
    """
    first = F.date_add(F.col(latest_col), 1 - lookback_days)
    last = today if isinstance(today, Column) else as_date(today)
    return latest.select(F.explode(days_between(first, last)).alias(alias))


def read_latest_loaded(spark: SparkSession, target_path: str, date_col: str,
                       default: str | _dt.date) -> DataFrame:
    """High-water date of a folder partitioned by ``date_col``; ``default`` when
    it is missing or empty.

    Taken from the names of its first-level folders (one per day): no file is listed
    and no row is read, so it costs the same for a day of data as for ten years."""
    names = [n.split("=", 1)[1] for n in Folder(spark, target_path).names() if n.startswith(f"{date_col}=")]
    days = spark.createDataFrame([(n,) for n in names], "day string").select(F.expr("try_cast(day AS DATE)").alias(date_col))
    return latest_date(days, date_col, default)


def daily_backfill(spark: SparkSession, fact: DataFrame, dim: DataFrame, target_path: str, *,
                   default_start: str | _dt.date, today: str | _dt.date,
                   lookback_days: int = 0, out_date_col: str = "sale_date",
                   **etl_args) -> DataFrame:
    """Load every pending day into ``target_path`` with one job.

    The high-water date is read from the target (``default_start`` when empty),
    the pending days are ``latest+1 .. today``, and the whole run is written at
    once with dynamic partition overwrite, so a re-run replaces the same
    partitions and leaves the others alone. A reloaded day (``lookback_days``) that
    has no rows left is emptied. Returns the pending-day frame.
    """
    latest = read_latest_loaded(spark, target_path, out_date_col, default_start)
    days = pending_days(latest, today, lookback_days=lookback_days)
    bounds = days.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    # the days of this run, fixed now (the lazy frame would re-list the target)
    run = spark.createDataFrame([(bounds["first"], bounds["last"])], "first date, last date") \
        .select(F.explode(days_between(F.col("first"), F.col("last"))).alias("day"))
    if bounds["first"] is None:
        return run
    frame = backfill_frame(fact, dim, bounds["first"], bounds["last"],
                           out_date_col=out_date_col, **etl_args)
    overwrite_partitions(frame, target_path, [out_date_col])
    if lookback_days > 0:  # only reloaded days can have rows in the target
        filled = frame.select(F.col(out_date_col).alias("day")).distinct()
        for row in run.join(filled, "day", "left_anti").collect():  # at most one row per day of the run
            _drop_folder(spark, f"{target_path.rstrip('/')}/{out_date_col}={row['day'].isoformat()}")
    return run


def run_day(spark: SparkSession, landing: str, facts: str, dim: DataFrame, target: SnapshotTable, day: str | _dt.date, *,
            fmt: str = "parquet", **etl_args) -> DataFrame:
    """The one-day pipeline in one call: the day's landing folder is copied into ``facts`` (replacing that
    day there), filtered, joined to ``dim``, and that partition of ``target`` is replaced, which
    empties it if no row is left. Returns the day's rows as the target holds them."""
    from ..sources.files import copy_day

    day = day if isinstance(day, str) else day.isoformat()
    copy_day(spark, landing, facts, day, fmt=fmt)
    copied = spark.read.format(fmt).option("header", True).load(f"{facts.rstrip('/')}/ingest_date={day}")
    rows = daily_etl(copied, dim, day, out_date_col=target.column, **etl_args)
    target.commit(rows, replaces=[day])
    return target.read(only=[day])


def backfill_snapshot(fact: DataFrame, dim: DataFrame, target: SnapshotTable, *, default_start: str | _dt.date,
                      today: str | _dt.date, lookback_days: int = 0, **etl_args) -> DataFrame:
    """:func:`daily_backfill` into a snapshot table: all pending days appear together, a
    reloaded day without rows is emptied in the same step, the days come from the
    manifest (no file is listed), and the frame is computed once. Returns the pending days."""
    spark = fact.sparkSession
    known = target.values()
    latest = spark.range(1).select((as_date(known[-1]) if known else as_date(default_start)).alias("latest_date"))
    days = [r["day"] for r in pending_days(latest, today, lookback_days=lookback_days).orderBy("day").collect()]  # one row per day
    run = spark.createDataFrame([(d,) for d in days], "day date")
    if days:
        frame = backfill_frame(fact, dim, days[0], days[-1], out_date_col=target.column, **etl_args)
        target.commit(frame, replaces=[d.isoformat() for d in days])
    return run


def _drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a partition folder, if there is one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
