"""Size-checked broadcast."""

from pyspark.sql import functions as F

from millrace.plans import joins


def test_bounds_on_rows_and_bytes(spark):
    narrow = spark.range(1000)
    assert joins.bounded_rows(narrow, 1000)
    assert not joins.bounded_rows(narrow, 999)
    wide = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("t"))
    assert joins.bounded_rows(wide, 1000, max_bytes=2_000_000)
    assert not joins.bounded_rows(wide, 1000, max_bytes=500_000)
    assert joins.bounded_rows(spark.range(0), 0)


def test_broadcast_hint_only_when_small(spark):
    small = joins.broadcast_if_small(spark.range(10), 100)
    big = joins.broadcast_if_small(spark.range(1000), 100)
    joined_small = spark.range(100000).join(small, "id")
    joined_big = spark.range(100000).join(big, "id")
    assert "broadcast" in joined_small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in joined_big._jdf.queryExecution().analyzed().toString().lower()
