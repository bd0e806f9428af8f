"""Merge rules and row consolidation (made-up rows)."""

from pyspark.sql import functions as F

from millrace.operators import merge
from millrace.sources import files
from tests.conftest import rows

PARTS_CSV = """sku,title,shelf,tag
k7,bolt,A1,steel
k9,,B2,
k9,washer,,
k9,washer,,zinc
m1,,,
"""


def test_merge_rows_golden(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(PARTS_CSV)
    df = files.read_csv_text(spark, str(path))
    out = merge.merge_rows(df, "sku")
    assert out.columns == ["sku", "title", "shelf", "tag"]
    assert [tuple(r) for r in out.collect()] == [
        ("k7", "bolt", "A1", "steel"), ("k9", "washer", "B2", "zinc"), ("m1", "", "", "")]


def test_merge_rows_keys_and_blanks(spark):
    df = spark.createDataFrame(
        [(None, "x"), ("", "y"), (" ", "z"), ("10", " a\t"), ("10", "a"), ("2", "\n"), ("10", "B")],
        "id string, v string")
    out = [tuple(r) for r in merge.merge_rows(df, "id").collect()]
    # null/empty keys dropped, blank-only key kept; text order of keys: " " < "10" < "2"
    assert out == [(" ", "z"), ("10", "B a"), ("2", "")]


def test_merge_rows_order_independent(spark):
    data = [(str(i % 7), f"v{(i * 13) % 5}") for i in range(200)]
    a = merge.merge_rows(spark.createDataFrame(data, "k string, v string"), "k")
    b = merge.merge_rows(spark.createDataFrame(list(reversed(data)), "k string, v string").repartition(3), "k")
    assert rows(a) == rows(b)


TARGET = [(1, "a", 10.0, "x"), (2, "b", 20.0, "y"), (3, "c", 30.0, "z"), (None, "n", 0.0, "q")]
SCHEMA = "k bigint, name string, bal double, seg string"


def _target(spark):
    return spark.createDataFrame(TARGET, SCHEMA)


def test_three_rules_differ_on_null_and_absent(spark):
    t = _target(spark)
    delta = spark.createDataFrame([(2, "B", None), (4, "D", 40.0), (None, "N", 1.0)],
                                  "k bigint, name string, bal double")
    coalesce = rows(merge.upsert_coalesce(t, delta, "k"))
    update = rows(merge.upsert_update(t, delta, "k"))
    replace = rows(merge.upsert_replace(t, delta, "k"))
    # coalesce: null keeps old value, absent column keeps old, new key gets null for absent
    assert coalesce == rows(spark.createDataFrame(
        [(1, "a", 10.0, "x"), (2, "B", 20.0, "y"), (3, "c", 30.0, "z"), (4, "D", 40.0, None),
         (None, "n", 0.0, "q"), (None, "N", 1.0, None)], SCHEMA))
    # update: null overwrites, absent column keeps old
    assert update == rows(spark.createDataFrame(
        [(1, "a", 10.0, "x"), (2, "B", None, "y"), (3, "c", 30.0, "z"), (4, "D", 40.0, None),
         (None, "n", 0.0, "q"), (None, "N", 1.0, None)], SCHEMA))
    # replace: whole delta row replaces (absent column becomes null)
    assert replace == rows(spark.createDataFrame(
        [(1, "a", 10.0, "x"), (2, "B", None, None), (3, "c", 30.0, "z"), (4, "D", 40.0, None),
         (None, "n", 0.0, "q"), (None, "N", 1.0, None)], SCHEMA))


def test_duplicates_per_rule(spark):
    t = _target(spark)
    delta = spark.createDataFrame([(1, "p", 1.0, 1), (1, "q", None, 2), (5, "r", 5.0, 1)],
                                  "k bigint, name string, bal double, seq int")
    upd = rows(merge.upsert_update(t, delta, "k", order_by="seq"))
    assert (1, "q", None, "x") in upd and (5, "r", 5.0, None) in upd
    assert len([r for r in upd if r[0] == 1]) == 1
    # coalesce fans out duplicate delta keys, one result row each
    co = rows(merge.upsert_coalesce(t, delta, "k"))
    assert sorted(r[1] for r in co if r[0] == 1) == ["p", "q"]
    # replace keeps every duplicate unless asked to dedupe
    assert len([r for r in rows(merge.upsert_replace(t, delta, "k")) if r[0] == 1]) == 2
    dd = rows(merge.upsert_replace(t, delta, "k", dedupe_by="seq"))
    assert [r for r in dd if r[0] == 1] == [(1, "q", None, None)]


def test_upserts_idempotent(spark):
    t = _target(spark)
    delta = spark.createDataFrame([(2, "B", 21.0), (4, "D", 40.0)], "k bigint, name string, bal double")
    for rule in (merge.upsert_update, merge.upsert_replace, merge.upsert_coalesce):
        once = rule(t, delta, "k")
        twice = rule(once, delta, "k")
        assert rows(once) == rows(twice)


def test_delta_cast_to_target_types(spark):
    t = _target(spark)
    delta = spark.createDataFrame([("2", "B", "oops"), ("3", "C", "31.5")], "k string, name string, bal string")
    out = {r[0]: r for r in rows(merge.upsert_coalesce(t, delta, "k")) if r[0] is not None}
    assert out[2][2] == 20.0  # failed cast is null, so the old value is kept
    assert out[3][2] == 31.5


def test_missing_key_rejected(spark):
    t = _target(spark)
    import pytest
    with pytest.raises(ValueError):
        merge.upsert_update(t, spark.createDataFrame([("B",)], "name string"), "k")


def test_latest_by_key_hot_key(spark):
    df = spark.range(0, 30000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                      F.col("id").alias("seq"))
    out = merge.latest_by_key(df, "k", "seq")
    assert out.filter("k = 0").collect()[0]["seq"] == 29997
    assert out.count() == 20001


def test_small_and_large_delta_plans_agree(spark):
    t = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("name"),
                                   F.col("id").cast("double").alias("bal"), F.lit("s").alias("seg"))
    t = t.unionByName(spark.createDataFrame([(None, "n", 1.0, "q")], SCHEMA))
    delta = spark.range(300, 700).select(
        F.when(F.col("id") % 5 == 0, F.lit(400)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("name"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") * 2.0).alias("bal"),
        F.col("id").alias("seq"))
    delta = delta.unionByName(spark.createDataFrame([(None, "N", 2.0, 1)], "k bigint, name string, bal double, seq bigint"))
    for rule, kw in ((merge.upsert_coalesce, {}), (merge.upsert_update, {"order_by": "seq"}),
                     (merge.upsert_replace, {})):
        small = rows(rule(t, delta, "k", **kw))
        large = rows(rule(t, delta, "k", broadcast_rows=0, **kw))
        assert small == large, rule.__name__
