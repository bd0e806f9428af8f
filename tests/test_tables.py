"""Partition overwrite, self-overwrite swap, partition listing, verify, loads."""

from pyspark.sql import functions as F

from millrace.sources import files, tables
from tests.conftest import rows


def _sales(spark):
    return spark.createDataFrame(
        [("t1", 1.0, "2024-01-01"), ("t2", 2.0, "2024-01-02"), ("t3", 3.0, "2024-01-02")],
        "transaction_id string, sale_amount double, sale_date string").withColumn("sale_date", F.to_date("sale_date"))


def test_static_and_dynamic_partition_overwrite(spark, tmp_path):
    tables.create_table(spark, "final_sales", [("transaction_id", "STRING"), ("sale_amount", "DOUBLE")],
                        partition_by=[("sale_date", "DATE")], location=str(tmp_path / "fs"), replace=True)
    tables.load_table(_sales(spark), "final_sales")
    new_day = spark.createDataFrame([("t9", 9.0)], "transaction_id string, sale_amount double")
    tables.overwrite_partition(spark, new_day, "final_sales", {"sale_date": "2024-01-02"})
    got = rows(spark.table("final_sales"), "transaction_id")
    assert got == [("t1",), ("t9",)]
    dyn = spark.createDataFrame([("t5", 5.0, "2024-01-03")], "a string, b double, d string") \
        .withColumn("d", F.to_date("d"))
    tables.overwrite_partition(spark, dyn, "final_sales")
    assert rows(spark.table("final_sales"), "transaction_id") == [("t1",), ("t5",), ("t9",)]
    assert tables.latest_partition(spark, "final_sales").first()[0] == "sale_date=2024-01-03"


def test_latest_partition_none(spark, tmp_path):
    tables.create_table(spark, "empty_parts", [("a", "INT")], partition_by=[("p", "STRING")],
                        location=str(tmp_path / "ep"), replace=True)
    assert tables.latest_partition(spark, "empty_parts").first()[0] is None


def test_overwrite_table_reading_itself(spark, tmp_path):
    spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "v1"))
    spark.sql("DROP TABLE IF EXISTS selfie")
    spark.sql(f"CREATE TABLE selfie USING parquet LOCATION '{tmp_path / 'v1'}'")
    doubled = spark.table("selfie").select((F.col("id") * 2).alias("id"))
    tables.overwrite_table(spark, doubled, "selfie")
    assert rows(spark.table("selfie")) == [(0,), (2,), (4,), (6,), (8,)]


def test_external_and_verify(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, p string")
    files.write_files(df, str(tmp_path / "ext"), "parquet", partition_by=["p"])
    t = tables.register_external(spark, "ext_t", str(tmp_path / "ext"),
                                 columns=[("id", "INT"), ("v", "STRING")], partition_by=[("p", "STRING")])
    assert rows(t) == [(1, "a", "x"), (2, "b", "y")]
    rep = tables.verify_table(t).first()
    assert (rep["row_count"], rep["n_columns"], rep["column_list"]) == (2, 3, "id,v,p")
    assert tables.sample_rows(t, 1).count() == 1


def test_copy_day_and_like(spark, tmp_path):
    src = tmp_path / "day"
    spark.createDataFrame([(1,), (2,)], "a int").write.parquet(str(src))
    files.copy_day(spark, str(src), str(tmp_path / "dst"), "2024-03-01")
    files.copy_day(spark, str(src), str(tmp_path / "dst"), "2024-03-01")  # re-run replaces
    back = spark.read.parquet(str(tmp_path / "dst"))
    assert back.count() == 2 and str(back.first()["ingest_date"]) == "2024-03-01"
    spark.sql("DROP TABLE IF EXISTS like_src")
    spark.sql("DROP TABLE IF EXISTS like_dst")
    spark.sql(f"CREATE TABLE like_src USING parquet LOCATION '{src}'")
    tables.create_like(spark, "like_dst", "like_src", location=str(tmp_path / "like"))
    assert spark.table("like_dst").columns == ["a"] and spark.table("like_dst").count() == 0


def test_overwrite_csv_table_keeps_format_and_place(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS selfie_csv")
    spark.sql(f"CREATE TABLE selfie_csv (id INT, v STRING) USING csv OPTIONS (header 'true', sep ';') LOCATION '{tmp_path / 'c'}'")
    spark.sql("INSERT INTO selfie_csv VALUES (1, 'a;b'), (2, 'c')")
    where = tables.overwrite_table(spark, spark.table("selfie_csv").selectExpr("v", "id + 1 AS id"), "selfie_csv")
    assert where.rstrip("/").endswith("/c")
    assert rows(spark.table("selfie_csv")) == [(2, "a;b"), (3, "c")]


def test_overwrite_table_stays_beside_its_old_place(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    spark.sql("DROP TABLE IF EXISTS beside")
    spark.sql(f"CREATE TABLE beside USING parquet LOCATION '{tmp_path / 't'}'")
    for _ in range(2):
        where = tables.overwrite_table(spark, spark.table("beside").selectExpr("id + 1 AS id"), "beside")
        assert where.rsplit("/", 1)[0].endswith(str(tmp_path)) and where.count("__swap") == 1
    assert rows(spark.table("beside")) == [(2,), (3,), (4,)]
