"""Property checks (hypothesis): batch ranges and chunking invariants."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import chunks


@given(st.integers(1, 5000), st.integers(1, 60))
def test_batch_ranges_contiguous_balanced(total, batches):
    ranges = [chunks.batch_range(total, batches, b) for b in range(1, batches + 1)]
    nonempty = [r for r in ranges if r[0] <= r[1]]
    assert nonempty[0][0] == 1 and nonempty[-1][1] == total
    for a, b in zip(nonempty, nonempty[1:]):
        assert b[0] == a[1] + 1
    sizes = [r[1] - r[0] + 1 for r in nonempty]
    assert max(sizes) - min(sizes) <= 1
    assert sizes == sorted(sizes, reverse=True)  # remainder goes to the first batches
    assert chunks.batch_range(total, batches, batches + 1) == []


@settings(max_examples=8, deadline=None)
@given(st.integers(1, 300), st.integers(1, 20))
def test_spark_batches_and_chunks_match_rules(spark, total, n):
    df = spark.range(1, total + 1).withColumnRenamed("id", "k")
    got = {r["k"]: r["b"] for r in chunks.with_row_index(df, "k", "i").select(
        "k", chunks.balanced_batch(F.col("i"), F.col("__total"), n).alias("b")).collect()}
    for b in range(1, n + 1):
        lo, hi = chunks.batch_range(total, n, b)
        assert all(got[k] == b for k in range(lo, hi + 1))
    size = -(-total // n)
    ch = {r["k"]: r["chunk_id"] for r in chunks.assign_chunks(df, n, "k").collect()}
    assert all(ch[k] == (k - 1) // size + 1 for k in range(1, total + 1))
