"""Shared pieces of the training-data operators: table access, held-out rows,
written intermediates and bounded slices of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Words of the contracts: maximal runs of anything but these six characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Text handled at once inside a Python worker; a longer single text is handled alone.
SLICE_BYTES = 4 << 20

#: Rows sent to a Python worker at once; a longer single row goes alone.
BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def workers_find_package(spark: SparkSession) -> None:
    """Python workers started from now on can import this package where it is
    installed at the driver's path; elsewhere ship it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of this session hold about ``BATCH_BYTES`` at most, as executor and
    worker each hold a batch, and copies of it while it grows; the user's own setting stays."""
    if _BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doc_texts(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), and the named extra columns; other
    columns of the table, whatever their names, play no part."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
                       *[docs[c].alias(c) for c in extra])


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels must not be learned from (a fifth of them)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def written(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back, so a
    lost executor costs one stage and not the whole chain."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: What worker processes keep warm from task to task: dicts that may be emptied at any time.
WARM: list[dict] = []


def give_back() -> None:
    """Give freed memory back to the system (where the libraries can): workers wait between
    tasks, and next to other workers, with all that they have not given back."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def release_memory() -> None:
    """Empty what earlier stages kept warm in this worker process, which is reused from stage to
    stage, and give freed memory back to the system."""
    for kept in WARM:
        kept.clear()
    gc.collect()
    give_back()


def start_afresh(spark: SparkSession) -> None:
    """Before a stage: worker processes drop what earlier stages kept, and the executors' JVMs
    collect their garbage, as they give unused heap back to the system only then. A task for
    each core, so a worker or a JVM may be missed; no result depends on it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        yield from batches

    workers_find_package(spark)
    cores = spark.sparkContext.defaultParallelism
    tasks = spark.range(0, cores, 1, cores).mapInArrow(run, "id long")
    tasks.select(F.reflect(F.lit("java.lang.System"), F.lit("gc"))).collect()


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` at once. After the
    last one the worker gives back what its task has freed."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        start, size = 0, 0
        for i, n in enumerate(ends.to_pylist()):
            if size and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        yield batch.slice(start)
    batch = ends = None
    give_back()


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes."""
    at = batch.schema.get_field_index(column)
    return pc.fill_null(batch.column(at).cast(pa.binary()), b"").to_pylist()
