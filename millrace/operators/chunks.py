"""Row numbering, chunking and paging without a single-task global window.

A global ``row_number()`` with no partition moves every row into one task.
Instead the order is cut into ranges with fixed bounds (:mod:`.ranges`): counts per
range say what lies before each, and rows are numbered inside their ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_of, serial
from ..plans.joins import broadcast_if_small
from ..session import written
from .ranges import NotRangeable, Ranges

_PID = "__pid"
_LOCAL = "__local"


def _order_cols(order_by: str | Column | Sequence[str | Column]) -> list[Column]:
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    return [col_of(c) for c in order_by]


def with_row_index(df: DataFrame, order_by, index_col: str = "row_index", *,
                   num_partitions: int | None = None, tie_break: bool = True) -> DataFrame:
    """Add ``index_col`` = 1..N following ``order_by`` (ascending).

    ``tie_break`` appends ``xxhash64`` of the whole row to the order, so rows
    that tie on ``order_by`` are still numbered the same way on every run
    (identical rows are interchangeable). Adds the column ``__total`` (N) too;
    callers drop it or use it. The rows are dealt to ranges with fixed bounds
    (see :mod:`.ranges`), ``num_partitions`` of them; nothing is written. An order that cannot be cut so
    (descending or nested columns) rests on a written range exchange instead.
    """
    order = _order_cols(order_by)
    try:
        ranges = Ranges(df, order, tie_break=tie_break, ranges=num_partitions)
    except NotRangeable:
        return _with_written_index(df, order, index_col, num_partitions, tie_break)
    return ranges.numbered(index_col).withColumn("__total", F.lit(ranges.total).cast("long"))


def _with_written_index(df: DataFrame, order: list[Column], index_col: str, num_partitions: int | None, tie_break: bool) -> DataFrame:
    spark = df.sparkSession
    if tie_break:
        order = order + [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # monotonically_increasing_id = (partition << 33) + position in partition
    local = df.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_LOCAL))
    # counts and numbers must come from one and the same range exchange: its rows are
    # written to the shared folder once, and a lost executor does not deal them anew
    local = written(local, "row-index")
    counts = local.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()  # over <= num_partitions rows
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
        F.sum("__n").over(every).alias("__total"))
    # one row per partition: a proven-small side
    numbered = local.join(F.broadcast(offsets), _PID)
    index = (F.col(_LOCAL) - F.shiftleft(F.col(_PID).cast("long"), 33)) + F.col("__offset") + 1
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns],
                           index.alias(index_col), F.col("__total"))


def running_before(df: DataFrame, order_by, weight: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all rows that come before in the order (unique
    ascending keys). Two levels: sums per range of the order, then inside the ranges."""
    return Ranges(df, _order_cols(order_by), tie_break=False, weight=F.col(weight)).running(name)


def with_split_order_index(df: DataFrame, split_cols, position_col: str, index_col: str = "row_index",
                           *, broadcast_rows: int = 2_000_000) -> DataFrame:
    """Number rows 1..N in storage order without moving them.

    ``split_cols`` identify the input split a row was read from (e.g. file path
    and split start) and sort the splits in storage order; ``position_col`` is a
    ``monotonically_increasing_id()`` taken at the scan, so it grows inside a
    split. Each split's offset is the row count of the splits before it, summed
    in two levels; only the per-split table (one row per input split, written once)
    travels, broadcast when its row count is proven small, else joined by shuffle."""
    split_cols = [split_cols] if isinstance(split_cols, str) else list(split_cols)
    per_split = written(df.groupBy(*split_cols).agg(F.count(F.lit(1)).alias("__n"), F.min(position_col).alias("__first")), "splits")
    offsets = running_before(per_split, split_cols, "__n", "__offset").drop("__n")
    numbered = df.join(broadcast_if_small(offsets, broadcast_rows), split_cols)
    index = F.col(position_col) - F.col("__first") + F.col("__offset") + 1
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], index.alias(index_col))


def check_count(n, name: str = "count", default_if_nonpositive: int | None = None) -> int:
    """Validate a positive integer argument (``bool`` and text are rejected)."""
    if isinstance(n, bool) or not isinstance(n, int):
        raise ValueError(f"{name} must be a positive integer, got {n!r}")
    if n <= 0:
        if default_if_nonpositive is not None:
            return default_if_nonpositive
        raise ValueError(f"{name} must be a positive integer, got {n!r}")
    return n


def assign_chunks(df: DataFrame, n: int, order_by, chunk_col: str = "chunk_id", *,
                  index_col: str = "row_index", default_if_nonpositive: int | None = None,
                  **index_args) -> DataFrame:
    """Ceil-sized chunks: ``ceil(N/n)`` rows per chunk in order, the last one
    shorter; with more chunks than rows every row is its own chunk."""
    n = check_count(n, "number of chunks", default_if_nonpositive)
    numbered = with_row_index(df, order_by, index_col, **index_args)
    size = F.ceil(F.col("__total") / F.lit(n))
    chunk = F.floor((F.col(index_col) - 1) / size) + 1
    return numbered.withColumn(chunk_col, chunk.cast("int")).drop("__total")


def balanced_batch(index: Column, total: Column, batches: int) -> Column:
    """Batch (1-based) of a 1-based position under balanced splitting: sizes
    differ by at most one and the remainder goes to the first batches (the
    same split as ``ntile``)."""
    base = F.floor(total / F.lit(batches))
    rem = total - base * F.lit(batches)
    big = rem * (base + 1)  # positions covered by the larger batches
    return F.when(index <= big, F.floor((index - 1) / (base + 1)) + 1) \
        .otherwise(rem + F.floor((index - big - 1) / base) + 1).cast("int")


def batch_ranges(df: DataFrame, batches: int, order_by, key: str | None = None, *,
                 batch_col: str = "batch", **index_args) -> DataFrame:
    """Split the ordered rows into ``batches`` balanced batches and report, per
    batch, the first and last position, the row count and (with ``key``) the
    key range. Batches beyond the row count produce no row."""
    batches = check_count(batches, "number of batches")
    numbered = with_row_index(df, order_by, "__pos", **index_args)
    tagged = numbered.withColumn(batch_col, balanced_batch(F.col("__pos"), F.col("__total"), batches))
    aggs = [F.min("__pos").alias("start_pos"), F.max("__pos").alias("end_pos"),
            F.count(F.lit(1)).alias("rows")]
    if key is not None:
        aggs += [F.min(key).alias("min_key"), F.max(key).alias("max_key")]
    return tagged.groupBy(batch_col).agg(*aggs)


def batch_range(total: int, batches: int, current: int) -> list[int]:
    """``[start, end]`` suffix numbers (1-based, inclusive) of batch ``current``
    when 1..total is split into ``batches`` balanced batches; ``[]`` for a batch
    above ``batches``; ``ValueError`` on non-positive or non-integer input."""
    for name, v in (("total", total), ("batches", batches), ("current", current)):
        check_count(v, name)
    if current > batches:
        return []
    base, rem = divmod(total, batches)
    start = (current - 1) * base + 1 + min(current - 1, rem)
    end = current * base + min(current, rem)
    return [start, end]


#: Pages that begin beyond this many rows are found by counts, others by a top-k sort.
DEEP_PAGE = 100_000


def page(df: DataFrame, offset: int, limit: int, order_by=None) -> DataFrame:
    """``ORDER BY ... LIMIT limit OFFSET offset``. Ordering by all columns (the
    default) makes ties stable. Near the front Spark keeps only ``offset + limit``
    rows per task; a page that begins beyond ``DEEP_PAGE`` rows is located by
    :func:`deep_page`."""
    order = _order_cols(order_by) if order_by is not None else [F.col(f"`{c}`") for c in df.columns]
    if offset > DEEP_PAGE:
        try:
            return deep_page(df, offset, limit, order)
        except NotRangeable:
            pass
    return df.orderBy(*order).offset(offset).limit(limit)


def deep_page(df: DataFrame, offset: int, limit: int, order_by) -> DataFrame:
    """The same page by order statistics: counts per range of the order tell which one or
    two ranges hold it, and only their rows are sorted. Ties go by the row's hash."""
    return Ranges(df, _order_cols(order_by)).page(offset, limit)


def chunk_file_name(run_date: Column, chunk: Column, suffix: str = ".csv", naming: str = "dated") -> Column:
    """Export name of a chunk: ``YYYYMMDD-NN.csv`` (``dated``) or
    ``part_N.csv`` (``part``)."""
    if naming == "part":
        return F.concat(F.lit("part_"), chunk.cast("string"), F.lit(suffix))
    if naming != "dated":
        raise ValueError("naming must be 'dated' or 'part'")
    return F.concat(F.date_format(run_date, "yyyyMMdd"), F.lit("-"), serial(chunk), F.lit(suffix))
