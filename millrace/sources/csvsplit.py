"""CSV read by many tasks per file, quoted line breaks included, columns bound by
each file's own header.

A line break inside quotes does not end a record, and whether a position lies
inside quotes depends on every quote before it. Two passes settle that without
giving a file to one task:

1. Every input split counts its quotes; only whether the number is odd matters.
   A prefix XOR over the splits of a file (one row per split) tells each split
   whether it starts inside quotes.
2. Every split cuts its lines into records from there. Records that lie in one split
   go on as they are; the pieces of a record that crosses a border, at most two per
   split, meet in a small shuffle.

Cells are parsed by ``from_csv`` into one wide row, whatever the file's columns; a
table of header positions (one row per header) then gives each target column its
cell by name. So files whose headers order or choose columns differently are read in
one pass, and none is read by position.

Quotes are doubled inside quoted cells; a quote in an unquoted cell is not CSV. A
file with an odd number of quotes has no defined records: its rows are rejected
(or raise). Lines end in ``\\n`` or ``\\r\\n``; line breaks inside quotes stay as written.

Both passes must see the same splits. If a cluster deals the files differently in
between (its cores change while a small input is read), the second pass raises
instead of guessing; run it again, or set ``spark.sql.files.minPartitionNum``.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..session import unique_name, written
from .files import CSV_QUOTING

SOURCE = "_source_file"
MOST_HEADERS = 10_000  # different headers whose positions are broadcast
_WHOLE, _HEAD, _TAIL = 0, 1, 2
_PIECES = "file string, start long, kind int, first boolean, record string"


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines in storage order with the split they were read from."""
    raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths if isinstance(paths, str) else list(paths))
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _quotes(value: Column, quote: str) -> Column:
    return F.octet_length(value) - F.octet_length(F.replace(value, F.lit(quote), F.lit("")))


def split_states(lines: DataFrame, quote: str = '"') -> DataFrame:
    """One row per split: ``file, start, inside`` (0/1: whether it starts inside quotes), ``odd``
    (1 if its file holds an odd number of quotes), and the file's first line that is
    not empty (``head``, in the row of its first split)."""
    at = F.when((F.col("start") == 0) & ~F.col("value").isin("", "\r", "\ufeff"), F.monotonically_increasing_id())
    lines = lines.select("file", "start", "value", at.alias("at"))
    per = lines.groupBy("file", "start").agg((F.sum(_quotes(F.col("value"), quote)) % 2).alias("odd"), F.min_by("value", "at").alias("head"))
    whole = Window.partitionBy("file")
    before = whole.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("file", "start", "head", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("inside"),
                      (F.sum("odd").over(whole) % 2).cast("int").alias("odd"))


class _Split:
    """Cuts the lines of one split, fed in order, into records and border pieces."""

    def __init__(self, file: str, start: int, inside: int, quote: str):
        self.file, self.start, self.state, self.quote = file, start, inside, quote
        self.held: list[pa.Array] = []  # lines of the record that is still open
        self.kind = _HEAD if inside else _WHOLE
        self.first = start == 0  # the file's first record is still to come

    def feed(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        odd = np.asarray(pc.count_substring(lines, self.quote)) & 1
        after = (np.cumsum(odd) + self.state) & 1
        starts = np.flatnonzero((after ^ odd) == 0)  # lines that begin outside quotes
        if len(lines):
            self.state = int(after[-1])
        if not len(starts):
            self.held.append(lines)
            return
        self.held.append(lines.slice(0, starts[0]))
        yield from self._open_record(self.kind)
        if len(starts) > 1:
            offsets = pa.array(starts, pa.int32())
            yield from self._batch(_WHOLE, pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n"))
        self.kind, self.held = _WHOLE, [lines.slice(starts[-1])]

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self._open_record(_TAIL if self.kind == _WHOLE and self.state else self.kind)

    def _open_record(self, kind: int) -> Iterator[pa.RecordBatch]:
        if any(len(x) for x in self.held):
            yield from self._batch(kind, pa.array(["\n".join(x for part in self.held for x in part.to_pylist())], pa.string()))
        self.held = []

    def _batch(self, kind: int, records: pa.Array) -> Iterator[pa.RecordBatch]:
        n, first = len(records), np.zeros(len(records), bool)
        if self.first:
            filled = [i for i in range(min(n, 1000)) if records[i].as_py() not in ("", "\r", "\ufeff")]
            self.first = not filled
            first[filled[:1]] = True
        yield pa.RecordBatch.from_arrays([pa.array([self.file] * n, pa.string()), pa.array([self.start] * n, pa.int64()), pa.array([kind] * n, pa.int32()),
                                          pa.array(first), records.cast(pa.string())], names=["file", "start", "kind", "first", "record"])


def _cut(quote: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Split | None = None
        for batch in batches:
            # a task may read several splits, one after the other
            key = pc.binary_join_element_wise(batch.column("file"), batch.column("start").cast(pa.string()), "\n")
            n = batch.num_rows
            new = np.flatnonzero(pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)) + 1 if n > 1 else []
            cuts = [0, *map(int, new), n] if n else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                file, start, inside = (batch.column(c)[a].as_py() for c in ("file", "start", "inside"))
                if now is None or (now.file, now.start) != (file, start):
                    if now is not None:
                        yield from now.end()
                    now = _Split(file, start, inside, quote)
                yield from now.feed(batch.column("value").slice(a, b - a))
        if now is not None:
            yield from now.end()

    return run


@dataclass
class Records:
    """``records``: ``file, first, record`` (first: the file's header, if it has one);
    ``heads``: ``file, record`` of the first records; ``odd``: ``file`` names with an odd number of quotes."""

    records: DataFrame
    heads: DataFrame
    odd: DataFrame


def csv_records(spark: SparkSession, paths: str | Sequence[str], *, quote: str = '"') -> Records:
    """The records of the files with an even number of quotes; an empty line outside
    quotes is none. The first pass runs at once, the second when the records are used."""
    lines = _lines(spark, paths)
    states = written(split_states(lines, quote), "split-states")
    # one row per input split: a size-checked side
    side = broadcast_if_small(states.select(F.col("file").alias("of"), F.col("start").alias("at"), "inside", "odd"))
    known = lines.join(side, (F.col("file") == F.col("of")) & (F.col("start") == F.col("at")), "left")
    moved = F.raise_error(F.lit("the input's splits changed between two passes; run again or set spark.sql.files.minPartitionNum"))
    known = known.where(F.when(F.col("odd").isNull(), moved.cast("boolean")).otherwise(F.col("odd") == 0))
    cut = known.select("file", "start", "inside", "value").mapInArrow(_cut(quote), _PIECES)
    records = cut.where(F.col("kind") == _WHOLE).select("file", "first", "record")
    if not states.where("inside = 1 and odd = 0").isEmpty():  # some record crosses a border
        order = Window.partitionBy("file").orderBy("start", "kind")  # a split's head comes before its tail
        parts = cut.where(F.col("kind") != _WHOLE).withColumn("of", F.sum((F.col("kind") == _TAIL).cast("int")).over(order))
        whole = parts.groupBy("file", "of").agg(F.bool_or("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("parts"))
        records = records.unionByName(whole.select("file", "first", F.array_join(F.col("parts.record"), "\n").alias("record")))
    records = records.select("file", "first", F.regexp_replace("record", "\r$", "").alias("record")).where(~F.col("record").isin("", "\ufeff"))
    heads = states.where("head is not null and odd = 0").select("file", F.regexp_replace("head", "\r$", "").alias("record"))
    if not heads.where(_quotes(F.col("record"), quote) % 2 == 1).isEmpty():  # a line break in a header
        heads = written(records.where("first").select("file", "record"), "csv-heads")
    return Records(records, heads, states.where("odd = 1").select("file").distinct())


def header_names(header: str, sep: str = ",", quote: str = '"') -> list[str]:
    return next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline=""), delimiter=sep, quotechar=quote))


def read_csv_by_header(spark: SparkSession, paths: str | Sequence[str], *, columns: Sequence[str] | None = None,
                       required: Sequence[str] = (), sep: str = ",", quote: str = '"', source: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of all files under ``paths``, every cell as text, each file by its own header.

    ``columns``: the target columns (by default all names of any header, in order of first
    appearance by file name). A column that a file's header lacks is null in its
    rows, a file's other columns are left out; a file must name all of ``required`` and
    no column twice. A present but empty cell is ``''``. ``source`` adds ``_source_file``.

    ``rejects``: ``file, reason, record``. A row with fewer or more cells than its header
    (``cells``), all rows of a file whose header lacks a required column or names one
    twice (``header``), and each file with an odd number of quotes (``quotes``, without a record)."""
    found = csv_records(spark, paths, quote=quote)
    per_header = found.heads.groupBy("record").agg(F.min("file").alias("file")).orderBy("file").limit(MOST_HEADERS + 1).collect()
    if len(per_header) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers; read the files in smaller groups")
    named = {r["record"]: header_names(r["record"], sep, quote) for r in per_header}
    columns = list(columns) if columns is not None else list(dict.fromkeys(n for names in named.values() for n in names))
    widest = max((len(n) for n in named.values()), default=1)
    # a row per header, at most MOST_HEADERS
    places = spark.createDataFrame([(h, len(n), len(set(n)) == len(n) and set(required) <= set(n), [n.index(c) if c in n else -1 for c in columns])
                                    for h, n in named.items()], "header string, width int, fits boolean, places array<int>")
    files = found.heads.join(F.broadcast(places), F.col("record") == F.col("header")).select(F.col("file").alias("of"), "width", "fits", "places")
    rows = found.records.where("not first").join(broadcast_if_small(files), F.col("file") == F.col("of"))
    end = unique_name("end")  # a last cell of our own: its place counts the cells of the row
    schema = ", ".join(f"c{i} string" for i in range(widest + 1))
    options = {**CSV_QUOTING, "quote": quote, "escape": quote, "sep": sep, "multiLine": "true", "mode": "PERMISSIVE"}
    rows = rows.withColumn("row", F.from_csv(F.concat("record", F.lit(sep + end)), F.lit(schema), options))
    rows = rows.withColumn("cells", F.array(*[F.col(f"row.c{i}") for i in range(widest + 1)])).drop("row")
    rows = rows.withColumn("whole", F.coalesce(F.array_position("cells", end) - 1 == F.col("width"), F.lit(False)))
    place = [F.get("places", F.lit(i)) for i in range(len(columns))]
    cells = [F.when(p >= 0, F.coalesce(F.get("cells", p), F.lit(""))).alias(c) for c, p in zip(columns, place, strict=True)]
    out = rows.where("fits and whole").select(*cells, *([F.col("file").alias(SOURCE)] if source else []))
    reason = F.when(~F.col("fits"), F.lit("header")).otherwise(F.lit("cells"))
    rejects = rows.where("not (fits and whole)").select("file", reason.alias("reason"), "record")
    return out, rejects.unionByName(found.odd.select("file", F.lit("quotes").alias("reason"), F.lit(None).cast("string").alias("record")))
