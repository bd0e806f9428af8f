"""Ranges of an order with fixed bounds: numbers, running sums and pages."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import chunks
from millrace.operators.ranges import NotRangeable, Ranges


@pytest.fixture(scope="module")
def frame(spark):
    draw = random.Random(2)
    rows = []
    for i in range(3000):
        d = draw.choice([None, dt.datetime(2024, 3, 31, 1, 30) + dt.timedelta(minutes=draw.randrange(9000))])
        rows.append((draw.choice(["hot", "hot", "hot", "", None, "a'b\\n", "é"]), draw.choice([None, -0.0, 1e-300, float("nan"), draw.random()]), d, i % 7, f"row {i}"))
    return spark.createDataFrame(rows, "s string, x double, t timestamp, n int, text string").repartition(5)


def order_of(rows, names):
    """Values in the order of Spark's own sort."""
    return [tuple(str(r[n]) for n in names) for r in rows]


@pytest.mark.parametrize("names", [["s"], ["s", "x"], ["t", "n"], ["x"], ["text"]])
def test_numbers_follow_the_order_without_reuse_or_writes(spark, frame, names):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = chunks.with_row_index(frame, names, "id", num_partitions=16)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(out.collect(), key=lambda r: r["id"])
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert "LogicalRDD" not in plan.replace("LogicalRDD [s#", "", 1) and "parquet" not in plan
    assert [r["id"] for r in got] == list(range(1, 3001)) and {r["__total"] for r in got} == {3000}
    assert order_of(got, names) == order_of(frame.orderBy(*names).collect(), names)
    again = chunks.with_row_index(frame.repartition(3), names, "id", num_partitions=5)  # other bounds, the same numbers
    assert {r["text"]: r["id"] for r in again.collect()} == {r["text"]: r["id"] for r in got}


def test_ties_are_cut_into_ranges(frame):
    r = Ranges(frame, [F.lit(1)], ranges=16)
    assert len(r.sums) > 10 and max(r.sums) < 600 and r.total == 3000


def test_pages_equal_a_whole_sort(frame):
    order = ["s", "n", "text"]
    every = [x["text"] for x in frame.orderBy(*order).collect()]
    for offset, limit in ((0, 5), (1499, 7), (2990, 50), (3000, 5), (5000, 5), (10, 0), (0, 3000)):
        got = chunks.deep_page(frame, offset, limit, order)
        assert [x["text"] for x in got.collect()] == every[offset:offset + limit]


def test_running_sums_in_two_levels(spark):
    draw = random.Random(4)
    rows = [(f"/data/day={i % 90:03d}/part", 128 * (i // 90), draw.randrange(5)) for i in range(900)]
    got = chunks.running_before(spark.createDataFrame(rows, "file string, start long, n long"), ["file", "start"], "n", "before").collect()
    total, want = 0, {}
    for f, s, n in sorted(rows):
        want[f, s] = total
        total += n
    assert {(r["file"], r["start"]): r["before"] for r in got} == want


def test_orders_that_cannot_be_literals_and_small_frames(spark, frame):
    with pytest.raises(NotRangeable):
        Ranges(frame, [F.col("n").desc()])
    got = chunks.with_row_index(frame.limit(50), F.col("text").desc(), "id").orderBy("id").collect()
    assert [r["text"] for r in got] == sorted((r["text"] for r in got), reverse=True) and got[-1]["id"] == 50
    empty = spark.createDataFrame([], "k int")
    assert chunks.with_row_index(empty, "k").collect() == [] and chunks.deep_page(empty, 3, 3, "k").collect() == []
    same = spark.createDataFrame([(1,)] * 40, "k int")
    assert sorted(r["row_index"] for r in chunks.with_row_index(same, "k").collect()) == list(range(1, 41))
    binary = spark.createDataFrame([(bytes([i, 255]),) for i in range(60)], "k binary")
    got = chunks.with_row_index(binary, "k").orderBy("row_index").collect()
    assert [bytes(r["k"])[0] for r in got] == list(range(60))
