"""Daily partition ETL: one day, backfill, high-water date, pending days."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.plans import daily
from tests.conftest import rows

ARGS = dict(fact_key="product_id", dim_key="product_id", date_col="sale_ts",
            fact_select={"transaction_id": "transaction_id", "sale_amount": "sale_amount"},
            dim_select={"product_name": "product_name", "category": "category"},
            filters={"region": "North America"})


def _data(spark):
    sales = spark.createDataFrame([
        ("a", 1, 10.0, "North America", "2024-01-01 10:00:00"),
        ("b", 2, 20.0, "North America", "2024-01-02 23:59:59"),
        ("c", 1, 30.0, "Europe", "2024-01-02 08:00:00"),
        ("d", 9, 40.0, "North America", "2024-01-02 09:00:00"),  # no product row: dropped
        ("e", 2, 50.0, "North America", "2024-01-03 00:00:00"),
    ], "transaction_id string, product_id int, sale_amount double, region string, sale_ts string") \
        .withColumn("sale_ts", F.to_timestamp("sale_ts"))
    products = spark.createDataFrame([(1, "P1", "C1"), (2, "P2", "C2")],
                                     "product_id int, product_name string, category string")
    return sales, products


def test_daily_etl_one_day(spark):
    sales, products = _data(spark)
    out = daily.daily_etl(sales, products, "2024-01-02", **ARGS)
    assert rows(out) == [("b", 20.0, "P2", "C2", dt.date(2024, 1, 2))]


def test_backfill_pending_and_rerun(spark, tmp_path):
    sales, products = _data(spark)
    target = str(tmp_path / "target")
    days = daily.daily_backfill(spark, sales, products, target, default_start="2023-12-31",
                                today="2024-01-02", **ARGS)
    assert [r[0] for r in days.orderBy("day").collect()] == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    loaded = rows(spark.read.parquet(target), "transaction_id")
    assert loaded == [("a",), ("b",)]
    # up to date: nothing pending; next day picks up only the new day
    assert daily.daily_backfill(spark, sales, products, target, default_start="2023-12-31",
                                today="2024-01-02", **ARGS).count() == 0
    daily.daily_backfill(spark, sales, products, target, default_start="2023-12-31",
                         today="2024-01-03", **ARGS)
    assert rows(spark.read.parquet(target), "transaction_id") == [("a",), ("b",), ("e",)]
    # a look-back re-run rewrites the same partitions without duplicating rows
    daily.daily_backfill(spark, sales, products, target, default_start="2023-12-31",
                         today="2024-01-03", lookback_days=2, **ARGS)
    assert rows(spark.read.parquet(target), "transaction_id") == [("a",), ("b",), ("e",)]


def test_latest_date_default_and_pending(spark):
    empty = spark.createDataFrame([], "d date")
    latest = daily.latest_date(empty, "d", "2024-01-01")
    assert latest.first()[0] == dt.date(2024, 1, 1)
    days = daily.pending_days(latest, "2024-01-04")
    assert [r[0] for r in days.orderBy("day").collect()] == [dt.date(2024, 1, d) for d in (2, 3, 4)]
    assert daily.pending_days(latest, "2023-12-01").count() == 0


def test_lookback_empties_a_day_that_lost_its_rows(spark, tmp_path):
    sales, products = _data(spark)
    target = str(tmp_path / "emptied")
    daily.daily_backfill(spark, sales, products, target, default_start="2023-12-31", today="2024-01-03", **ARGS)
    left = sales.where("transaction_id != 'b'")
    daily.daily_backfill(spark, left, products, target, default_start="2023-12-31", today="2024-01-03", lookback_days=2, **ARGS)
    assert rows(spark.read.parquet(target), "transaction_id") == [("a",), ("e",)]
