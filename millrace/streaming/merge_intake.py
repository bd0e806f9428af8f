"""CSV files merged into keyed tables, file by file in order, with a status for each.

Files are found by a file stream whose checkpoint records which were taken; only names
go through it. Each batch of files is read by header (any order of columns, quoted
line breaks, many tasks per file) and merged into its targets one after the other, each
by its own rule: a first target that keeps old values where the file has none
(``coalesce``), then one that takes what the file says (``update``).

Every target notes the last batch it holds in the commit itself. If the second
target fails, the batch is tried again: the first target sees that it has the batch, the
second takes it then. A file is entered in the ledger only after all targets hold it:

* ``loaded``: all its rows were merged, ``partial``: some were rejected;
* ``header``, ``quotes``: no row could be read, the reason why;
* ``unreadable``: reading raised; the other files of the batch go on.

:func:`replay` takes files again that were mended after they were set aside.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..operators.merge import latest_by_key, latest_values
from ..session import written
from ..sources.csvsplit import SOURCE, read_csv_by_header
from ..sources.files import norm_uri, qualified
from ..sources.snapshots import KeyedTable

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
LEDGER_SCHEMA = "path string, status string, rows long, rejected long, batch_id long"
REJECT_SCHEMA = "path string, reason string, record string, batch_id long"


@dataclass
class Target:
    """A keyed table and the rule by which batches are merged into it."""

    table: KeyedTable
    rule: str


class Intake:
    """Merges batches of CSV files into ``targets``, which share keys and columns.

    ``order_by``: columns by which of two rows with one key the later is known; rows that
    tie there go by file name. ``ledger_dir`` and ``reject_dir`` get one partition per batch."""

    def __init__(self, spark: SparkSession, targets: Sequence[Target], *, order_by: Sequence[str], ledger_dir: str,
                 reject_dir: str, sep: str = ","):
        self.spark, self.targets, self.order_by, self.sep = spark, list(targets), list(order_by), sep
        self.ledger_dir, self.reject_dir = ledger_dir, reject_dir
        first = self.targets[0].table
        self.schema, self.keys = first.schema, first.keys

    def _typed(self, rows: DataFrame) -> DataFrame:
        """Text to the targets' types; text that is not of its type becomes null."""
        cells = [F.col(f.name) if isinstance(f.dataType, StringType) else F.col(f.name).try_cast(f.dataType).alias(f.name) for f in self.schema]
        return rows.select(*cells, SOURCE)

    def _staged(self, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        rows, rejects = read_csv_by_header(self.spark, paths, columns=self.schema.names, required=self.keys, sep=self.sep, source=True)
        return written(self._typed(rows), "intake-rows"), written(rejects, "intake-rejects")

    def _readable(self, paths: Sequence[str]) -> tuple[list[str], list[str]]:
        """Of the files of one batch those that can be read, and the others."""
        good, bad = [], []
        for path in paths:
            try:
                self.spark.read.text(path).agg(F.sum(F.octet_length("value"))).collect()
                good.append(path)
            except Exception:  # whatever the source raises: this file is set aside
                bad.append(path)
        return good, bad

    def take(self, paths: Sequence[str], batch: int, source: str = "stream") -> None:
        """Read, merge and enter the files of one batch; safe to repeat."""
        paths, bad = [qualified(self.spark, p) for p in paths], []
        try:
            rows, rejects = self._staged(paths)
        except Exception:
            good, bad = self._readable(paths)
            if not bad:
                raise
            paths = good
            rows, rejects = self._staged(good) if good else self._nothing()
        for target in self.targets:
            ordered = [*self.order_by, SOURCE]
            pick = latest_values if target.rule == "coalesce" else latest_by_key
            target.table.merge(pick(rows, self.keys, ordered).drop(SOURCE), target.rule, source=source, batch=batch)
        self._enter(paths, bad, rows, rejects, batch, source)

    def _nothing(self) -> tuple[DataFrame, DataFrame]:
        none = self.spark.createDataFrame([], StructType([*self.schema.fields, StructField(SOURCE, StringType())]))
        return none, self.spark.createDataFrame([], "file string, reason string, record string")

    def _enter(self, paths, bad, rows: DataFrame, rejects: DataFrame, batch: int, source: str) -> None:
        files = self.spark.createDataFrame([(p, False) for p in paths] + [(p, True) for p in bad], "path string, bad boolean")
        files = files.withColumn("name", norm_uri(F.col("path")))
        loaded = rows.groupBy(norm_uri(F.col(SOURCE)).alias("of")).agg(F.count(F.lit(1)).alias("n"))
        set_aside = rejects.groupBy(norm_uri(F.col("file")).alias("from")).agg(F.count("record").alias("m"), F.max("reason").alias("reason"))
        out = files.join(loaded, F.col("name") == F.col("of"), "left").join(set_aside, F.col("name") == F.col("from"), "left")
        status = F.when(F.col("bad"), "unreadable").when(F.col("reason").isin("header", "quotes"), F.col("reason")).when(
            F.col("m") > 0, "partial").otherwise("loaded")
        out = out.select(F.col("name").alias("path"), status.alias("status"), F.coalesce("n", F.lit(0)).alias("rows"), F.coalesce("m", F.lit(0)).alias("rejected"))
        part = f"source={source}/batch_id={batch}"
        rejects.withColumnRenamed("file", "path").write.mode("overwrite").parquet(f"{self.reject_dir}/{part}")
        out.write.mode("overwrite").parquet(f"{self.ledger_dir}/{part}")

    def stream(self, source_dir: str, *, checkpoint_dir: str, max_files_per_trigger: int = 100, glob: str = "*.csv*", wait: bool = True) -> StreamingQuery:
        """Take every file of ``source_dir`` that the checkpoint does not know yet, at most
        ``max_files_per_trigger`` a batch, then stop."""
        names = self.spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).option(
            "pathGlobFilter", glob).option("recursiveFileLookup", "true").load(source_dir).select("path")

        def merge_batch(batch: DataFrame, batch_id: int) -> None:
            paths = sorted(r["path"] for r in batch.collect())  # at most max_files_per_trigger names
            if paths:
                self.take(paths, batch_id)

        query = names.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
        if wait:
            query.awaitTermination()
        return query


def replay(intake: Intake, paths: Sequence[str]) -> None:
    """Take named files once more, as a batch of their own."""
    last = max(t.table.done("replay") for t in intake.targets)
    intake.take(sorted(paths), last + 1, source="replay")


def ledger(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """The last entry of each file (replays come after the stream): ``path, status, rows, rejected``."""
    try:
        entries = spark.read.schema(LEDGER_SCHEMA + ", source string").option("basePath", ledger_dir).parquet(ledger_dir)
    except AnalysisException:
        return spark.createDataFrame([], "path string, status string, rows long, rejected long")
    order = F.struct((F.col("source") == "replay").alias("replay"), "batch_id", "status", "rows", "rejected")
    return entries.groupBy("path").agg(F.max(order).alias("e")).select("path", "e.status", "e.rows", "e.rejected")
