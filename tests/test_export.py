"""Chunked export: file names, planned vs written manifest, resume."""

import pytest
from pyspark.sql import functions as F

from millrace.sources import export
from tests.conftest import rows


def test_export_resume_and_manifest(spark, tmp_path):
    df = spark.range(1, 24).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = str(tmp_path / "exp")
    export.export_chunks(df, 5, out, "k", "2024-02-03", only_chunks=[2])
    planned = export.export_chunks(df, 5, out, "k", "2024-02-03", resume=True)
    written = export.manifest(df, out)
    assert rows(planned) == rows(written) == [
        ("20240203-01.csv", 5), ("20240203-02.csv", 5), ("20240203-03.csv", 5),
        ("20240203-04.csv", 5), ("20240203-05.csv", 3)]
    back = spark.read.option("header", True).schema("k long, v long, file_name string").csv(out)
    assert rows(back.filter("file_name = '20240203-02.csv'"), "k") == [(k,) for k in range(6, 11)]


def test_export_single_file_and_default_count(spark, tmp_path):
    df = spark.range(0, 40).withColumnRenamed("id", "k")
    out = str(tmp_path / "one")
    m = export.export_chunks(df, 0, out, "k", "2024-01-01", single_file=True, default_if_nonpositive=15)
    assert len(rows(m)) == 14  # ceil(40/15)=3 rows per chunk -> 14 chunks
    import glob
    assert all(len(glob.glob(d + "/*.csv")) == 1 for d in glob.glob(out + "/file_name=*"))


def test_rewriting_a_chunk_replaces_it(spark, tmp_path):
    df = spark.range(1, 11).withColumnRenamed("id", "k")
    out = str(tmp_path / "again")
    export.export_chunks(df, 2, out, "k", "2024-01-01")
    export.export_chunks(df, 2, out, "k", "2024-01-01", only_chunks=[1])
    assert rows(export.manifest(df, out)) == [("20240101-01.csv", 5), ("20240101-02.csv", 5)]


def test_chunks_of_a_longer_export_are_refused(spark, tmp_path):
    df = spark.range(1, 11).withColumnRenamed("id", "k")
    out = str(tmp_path / "shrink")
    export.export_chunks(df, 5, out, "k", "2024-01-01")
    export.export_chunks(df, 2, out, "k", "2024-01-02")  # another run in the same folder
    with pytest.raises(ValueError, match="20240101-03.csv"):
        export.export_chunks(df, 2, out, "k", "2024-01-01")
    assert export.manifest(df, out).agg(F.sum("rows")).first()[0] == 20
    parts = str(tmp_path / "parts")
    export.export_chunks(df, 3, parts, "k", naming="part")
    with pytest.raises(ValueError, match="part_3.csv"):
        export.export_chunks(df, 2, parts, "k", naming="part", resume=True)
