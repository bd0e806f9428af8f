"""Merges into a bucketed table: the same rows as the general merges, and no exchange above the table."""

import re

import pytest

from millrace.operators import merge
from millrace.session import unique_name
from millrace.sources.bucketed import BucketedTable
from tests.conftest import rows


@pytest.fixture
def filled(spark):
    t = BucketedTable(spark, unique_name("bucketed"), "k", buckets=4)
    t.write(spark.createDataFrame([(i, f"old {i}", i * 1.0) for i in range(100)] + [(None, "null key", 0.0)], "k long, a string, b double"))
    return t


DELTA = [(3, "x", 5, 1), (3, None, 6, 2), (7, None, None, 1), (500, "new", 1, 1), (None, "other null", 2, 1)]


@pytest.mark.parametrize("rule, options", [("replace", {}), ("coalesce", {}), ("update", {"order_by": ["seq"]})])
def test_merges_move_only_the_delta(spark, filled, rule, options):
    delta = spark.createDataFrame(DELTA, "k long, a string, b int, seq int")
    target = spark.createDataFrame(filled.rows().collect(), filled.rows().schema)
    general = {"replace": merge.upsert_replace, "coalesce": merge.upsert_coalesce, "update": merge.upsert_update}[rule]
    want = rows(general(target, delta, "k", **options))
    out = filled.merged(delta, rule, **options)
    plan = out._jdf.queryExecution().executedPlan().toString()
    depth = lambda line: len(re.match(r"[\s:+-]*", line)[0])
    lines = plan.split("\n")
    scans = [i for i, line in enumerate(lines) if "Scan parquet" in line]
    assert scans and "SortMergeJoin" in plan
    for i in scans:  # no exchange on the way from the table's scan to the root
        at = depth(lines[i])
        for line in reversed(lines[:i]):
            if depth(line) < at:
                assert "Exchange" not in line, plan
                at = depth(line)
    assert rows(out) == want
    filled.merge(delta, rule, **options)
    assert rows(filled.rows()) == want
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {filled.name}").collect()}
    assert described["Num Buckets"] == "4"


def test_arguments(filled, spark):
    with pytest.raises(ValueError, match="key column"):
        filled.merged(spark.createDataFrame([("a",)], "a string"), "replace")
    with pytest.raises(ValueError, match="unknown merge rule"):
        filled.merged(spark.createDataFrame([(1,)], "k long"), "other")
