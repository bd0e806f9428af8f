"""Tasks hold no more as the input grows."""

import glob

from pyspark.sql import functions as F

from millrace import contract_ingest, contract_order
from millrace.operators import chunks, ranges


def test_numbering_deals_a_larger_input_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(ranges, "ROWS_PER_RANGE", 50)
    rows = spark.range(3000).select((F.col("id") % 3).alias("few"), F.col("id"))
    out = chunks.with_row_index(rows, "few", "n")
    per = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) == 3000 and max(per) <= 600  # on the 4 shuffle partitions it was 750 and more
    got = sorted((r["n"], r["few"]) for r in out.collect())
    assert [n for n, _ in got] == list(range(1, 3001)) and [k for _, k in got] == sorted(i % 3 for i in range(3000))


def test_distinct_numbers_are_counted_without_a_row_for_each(spark, tmp_path):
    rows = spark.range(70000).select(F.when(F.col("id") % 2 == 0, "A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit(0.5).alias("l_extendedprice"))
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    out = contract_order.q_row_id_wide(spark, str(tmp_path))
    assert "distinct" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r) for r in out.select("first_id", "last_id", "ids", "total", "price").collect()) == [
        (1, 35000, 35000, 70000, 17500.0), (35001, 70000, 35000, 70000, 17500.0)]


def test_one_task_writes_a_bounded_csv_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(contract_ingest, "FILE_BYTES", 4000)
    paths = []
    monkeypatch.setattr(contract_ingest, "scratch_path", lambda s, name: paths.append(str(tmp_path / name)) or paths[-1])
    rows = [(i, "en", None if i == 7 else f'a "quoted"\nline {i} ' + "x" * 40, None if i == 9 else "s") for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string, source string").repartition(12).write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in contract_ingest.q_csv_split_quotes(spark, str(tmp_path)).collect()}
    assert got == {(i, "" if t is None else f'say "{k}"\n\n{t}', s or "") for i, k, t, s in rows}
    assert len(glob.glob(f"{paths[0]}/*.csv")) > 1
