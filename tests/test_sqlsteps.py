"""Labelled SQL step scripts (sample script shape from the reference)."""

import pytest

from millrace.plans import sqlsteps

STATEMENTS = """
-- @label: create_users
CREATE TABLE {t} (id INT, name STRING, email STRING) USING parquet;

-- @label: insert_users
INSERT INTO {t} VALUES (1, 'Ann', 'a@x.org'), (2, 'Bob', 'b@x.org');

-- @label: select_users
SELECT id, name FROM {t} WHERE id >= :min_id;

-- @label: comment_only
-- SELECT * FROM nowhere;
"""


def test_statement_split_drops_comment_only():
    steps = sqlsteps.parse_script(STATEMENTS, "statements")
    assert [s.label for s in steps] == ["create_users", "insert_users", "select_users"]
    assert steps[2].sql.startswith("SELECT id, name")


def test_split_is_quote_aware():
    parts = sqlsteps.split_statements("SELECT 'a;b' AS x; -- c;\nSELECT 2;")
    assert parts == ["SELECT 'a;b' AS x", "-- c;\nSELECT 2"]


def test_run_statements(spark):
    script = STATEMENTS.format(t="steps_users")
    spark.sql("DROP TABLE IF EXISTS steps_users")
    out = sqlsteps.run_sql_steps(spark, script, args={"min_id": 2}, style="statements")
    assert [tuple(r) for r in out.collect()] == [(2, "Bob")]


def test_blocks_views_and_error_label(spark):
    script = """-- @label: nums
SELECT id FROM range(10)
-- @label: evens
SELECT count(*) AS n FROM nums WHERE id % 2 = 0
"""
    assert sqlsteps.run_sql_steps(spark, script).first()["n"] == 5
    with pytest.raises(RuntimeError, match="broken"):
        sqlsteps.run_sql_steps(spark, "-- @label: broken\nSELECT FROM WHERE")


def test_only_named_parameters_are_bound(spark):
    script = "-- @label: s\nSELECT :ab AS x -- :a in a comment\n"
    assert sqlsteps.run_sql_steps(spark, script, args={"a": 1, "ab": 2}).first()["x"] == 2
