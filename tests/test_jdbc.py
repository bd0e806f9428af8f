"""JDBC options and merge statements (no database is started in tests)."""

import pytest

from millrace.sources import jdbc


def test_options_and_unknown_kind():
    o = jdbc.jdbc_options("postgresql", host="db", port=5432, database="sales", user="u", password="p")
    assert o["url"] == "jdbc:postgresql://db:5432/sales" and o["driver"] == "org.postgresql.Driver"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("oracle", host="db", port=1, database="x", user="u", password="p")


def test_upsert_statements():
    pg = jdbc.upsert_statement("postgresql", "users", "users_stage", ["id", "name", "email"], ["id"])
    assert pg == ('INSERT INTO users ("id", "name", "email") SELECT "id", "name", "email" FROM users_stage '
                  'ON CONFLICT ("id") DO UPDATE SET "name" = EXCLUDED."name", "email" = EXCLUDED."email"')
    my = jdbc.upsert_statement("mysql", "users", "s", ["id", "name"], ["id"])
    assert my.endswith("ON DUPLICATE KEY UPDATE `name` = VALUES(`name`)")


def test_read_needs_one_source(spark):
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, {}, table="a", query="select 1")
