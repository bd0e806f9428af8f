"""Incremental file intake with Structured Streaming.

New files in a folder are picked up by the file source; the checkpoint (in
the shared folder) records which files were taken, so a restart processes
only files it has not committed -- this replaces renaming files to mark them.
Each micro-batch is written in order to its targets inside ``foreachBatch``:

0. (optional) malformed rows, with their source file, to a reject folder;
1. the keyed state: the batch's rows reduced to the latest row per key,
   written as the partition ``batch_id=<id>`` of the state folder;
2. the raw archive: the batch's rows as they came, also under ``batch_id=<id>``;
3. (optional) the ledger: the files the batch took.

Every write replaces exactly its ``batch_id`` partition, so a batch that is
re-run after a failure (Spark may repeat the last uncommitted batch) writes
the same files again instead of duplicating them; the second target is only
written after the first succeeded. The current state per key is read by
reducing all batches with the same latest-wins rule (combined map-side, so a
hot key is cheap).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..operators.merge import latest_by_key

BATCH_COL = "batch_id"


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH_COL).parquet(path))


CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"


def ingest_files(spark: SparkSession, source_dir: str, schema: StructType, *, state_dir: str,
                 archive_dir: str | None, checkpoint_dir: str, keys: Sequence[str],
                 order_by: Sequence[str], fmt: str = "parquet", max_files_per_trigger: int = 100,
                 options: dict[str, str] | None = None, reject_dir: str | None = None,
                 ledger_dir: str | None = None, wait: bool = True) -> StreamingQuery:
    """Take every file not yet committed in the checkpoint (``availableNow``),
    in micro-batches of at most ``max_files_per_trigger`` files, and upsert
    them (latest row per key wins) into ``state_dir``; raw rows go to
    ``archive_dir`` afterwards. With ``wait`` the call returns when the
    available files are done.

    ``reject_dir`` (CSV/JSON sources): malformed rows are kept apart with
    their source file instead of reaching the targets -- one bad file does
    not stop the others. ``ledger_dir``: the files each batch took, for
    :func:`pending_files` and audits."""
    read_schema = schema
    if reject_dir is not None:
        read_schema = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    reader = (spark.readStream.format(fmt).schema(read_schema)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if reject_dir is not None:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    stream = reader.load(source_dir).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    columns = [f.name for f in schema.fields]

    def write_both(batch: DataFrame, batch_id: int) -> None:
        # several writes read the batch: keep it once (recomputed from the
        # source files if an executor holding it is lost)
        batch = batch.persist()
        try:
            rows = batch
            if reject_dir is not None:
                rows = batch.filter(F.col(CORRUPT).isNull())
                _write_batch(batch.filter(F.col(CORRUPT).isNotNull()).select(SOURCE_FILE, CORRUPT),
                             reject_dir, batch_id)
            _write_batch(latest_by_key(rows.select(*columns), keys, order_by), state_dir, batch_id)
            if archive_dir is not None:
                _write_batch(rows.select(*columns), archive_dir, batch_id)
            if ledger_dir is not None:
                _write_batch(batch.select(F.col(SOURCE_FILE).alias("path")).distinct(), ledger_dir, batch_id)
        finally:
            batch.unpersist()

    query = (stream.writeStream.foreachBatch(write_both)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    if wait:
        query.awaitTermination()
    return query


def current_state(spark: SparkSession, state_dir: str, keys: Sequence[str], order_by: Sequence[str],
                  schema: StructType | None = None) -> DataFrame:
    """Latest row per key over every committed batch (empty if none yet)."""
    try:
        batches = spark.read.parquet(state_dir).drop(BATCH_COL)
    except AnalysisException:
        if schema is None:
            raise
        return spark.createDataFrame([], schema)
    return latest_by_key(batches, keys, order_by)


def compact_state(spark: SparkSession, state_dir: str, target_dir: str, keys: Sequence[str],
                  order_by: Sequence[str]) -> None:
    """Write the reduced state once to ``target_dir`` (e.g. nightly), so readers
    no longer reduce every batch."""
    current_state(spark, state_dir, keys, order_by).write.mode("overwrite").parquet(target_dir)


def pending_files(listing: DataFrame, ledger: DataFrame, name_col: str = "path") -> DataFrame:
    """Listed files not yet in the processed ledger (batch form of the intake)."""
    return listing.join(ledger.select(name_col).distinct(), name_col, "left_anti")
