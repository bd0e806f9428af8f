"""Batch ranges (worked examples from the reference), chunks, row index, paging."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import chunks
from tests.conftest import rows


@pytest.mark.parametrize("total,batches,expected", [
    (100, 2, [[1, 50], [51, 100]]),
    (100, 3, [[1, 34], [35, 67], [68, 100]]),
    (10, 1, [[1, 10]]),
    (7, 4, [[1, 2], [3, 4], [5, 6], [7, 7]]),
])
def test_batch_range_examples(total, batches, expected):
    assert [chunks.batch_range(total, batches, i) for i in range(1, batches + 1)] == expected


def test_batch_range_edges():
    assert chunks.batch_range(7, 4, 5) == []
    with pytest.raises(ValueError):
        chunks.batch_range(100, "2", 1)
    with pytest.raises(ValueError):
        chunks.batch_range(0, 2, 1)


def test_batch_ranges_match_ntile_and_scalar(spark):
    for total, batches in [(100, 3), (7, 4), (10, 6), (3, 5)]:
        df = spark.range(1, total + 1).withColumnRenamed("id", "k")
        got = rows(chunks.batch_ranges(df, batches, "k", key="k"), "batch", "start_pos", "end_pos")
        expect = [(b, *chunks.batch_range(total, batches, b)) for b in range(1, batches + 1)
                  if chunks.batch_range(total, batches, b)[0] <= chunks.batch_range(total, batches, b)[1]]
        assert got == expect


def test_chunks_differ_from_batches(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "k")
    sizes = rows(chunks.assign_chunks(df, 6, "k").groupBy("chunk_id").count())
    assert sizes == [(1, 2), (2, 2), (3, 2), (4, 2), (5, 2)]
    b = rows(chunks.batch_ranges(df, 6, "k"), "batch", "rows")
    assert [r[1] for r in b] == [2, 2, 2, 2, 1, 1]


def test_chunks_cover_every_row_once(spark):
    df = spark.range(0, 1003).select((F.col("id") * 7919 % 1003).alias("k"))
    out = chunks.assign_chunks(df, 15, "k", num_partitions=5)
    assert out.count() == 1003
    assert [r[0] for r in rows(out, "row_index")] == list(range(1, 1004))
    per = rows(out.groupBy("chunk_id").count())
    assert [c for _, c in per] == [67] * 14 + [1003 - 67 * 14]


def test_more_chunks_than_rows_and_bad_count(spark):
    df = spark.range(3)
    assert rows(chunks.assign_chunks(df, 10, "id"), "chunk_id") == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        chunks.assign_chunks(df, 0, "id")
    assert chunks.assign_chunks(df, 0, "id", default_if_nonpositive=15).count() == 3


def test_row_index_with_ties_is_stable(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z"), (1, "a")], "k int, v string")
    a = rows(chunks.with_row_index(df, "k", "i").drop("__total"))
    b = rows(chunks.with_row_index(df.repartition(3), "k", "i").drop("__total"))
    assert a == b
    assert [r[2] for r in sorted(a, key=lambda r: r[2])] == [1, 2, 3, 4]
    assert [r for r in a if r[2] == 1][0][0] == 0


def test_page(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    assert [r[0] for r in chunks.page(df, 10, 5, "k").collect()] == [10, 11, 12, 13, 14]


def test_range_tie_break_splits_a_hot_key(spark):
    # a third of the rows share one order value; the row-hash tie-break spreads them
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("v"))
    ranged = df.repartitionByRange(6, F.col("k"), F.xxhash64("k", "v"))
    sizes = [r[1] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.25 * 30000
    out = chunks.with_row_index(df, "k", "i", num_partitions=6)
    assert out.select(F.min("i"), F.max("i"), F.countDistinct("i")).first() == (1, 30000, 30000)


def test_row_index_is_gapless_without_tie_break_or_exchange_reuse(spark):
    from millrace.operators import chunks
    df = spark.range(5000).selectExpr("id", "id % 3 AS k", "repeat('x', 50) AS wide")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        for tie_break in (False, True):
            got = chunks.with_row_index(df, "k", tie_break=tie_break).select("row_index", "k").collect()
            assert sorted(r[0] for r in got) == list(range(1, 5001))
            assert [r[1] for r in sorted(got)] == sorted(r[1] for r in got)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
