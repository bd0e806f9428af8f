"""Registered queries of merges with large deltas into a bucketed table, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contract import table
from .session import unique_name
from .sources.bucketed import BucketedTable


def _merged(spark: SparkSession, sf_dir: str, rule: str, **options) -> DataFrame:
    """Customers, bucketed by key, after a merge with every order as a row of the delta."""
    customers = BucketedTable(spark, unique_name("customers"), "c_custkey", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    customers.write(table(spark, sf_dir, "customer"))
    delta = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("c_acctbal"),
        F.concat(F.lit("order "), F.col("o_orderpriority")).alias("c_name"), "o_orderkey")
    customers.merge(delta, rule, **options)
    return customers.rows()


def q_replace_large_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, "replace")


def q_coalesce_large_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, "coalesce")


def q_update_large_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, "update", order_by=["o_orderkey"])


QUERIES = {"replace_large_delta": q_replace_large_delta, "coalesce_large_delta": q_coalesce_large_delta, "update_large_delta": q_update_large_delta}

_DELTA = """
    WITH d AS (SELECT o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS bal, 'order ' || o_orderpriority AS name, o_orderkey FROM orders)"""

ORACLE_SQL: dict[str, str] = {
    "replace_large_delta": _DELTA + """
        SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM d)
        UNION ALL BY NAME SELECT o_custkey AS c_custkey, name AS c_name, bal AS c_acctbal FROM d""",
    "coalesce_large_delta": _DELTA + """
        SELECT c.* REPLACE (coalesce(d.o_custkey, c.c_custkey) AS c_custkey, coalesce(d.name, c.c_name) AS c_name, coalesce(d.bal, c.c_acctbal) AS c_acctbal)
        FROM customer c FULL OUTER JOIN d ON c.c_custkey = d.o_custkey""",
    "update_large_delta": _DELTA + """,
        l AS (SELECT o_custkey, last(bal ORDER BY o_orderkey) AS bal, last(name ORDER BY o_orderkey) AS name FROM d GROUP BY o_custkey)
        SELECT c.* REPLACE (coalesce(l.o_custkey, c.c_custkey) AS c_custkey, CASE WHEN l.o_custkey IS NULL THEN c.c_name ELSE l.name END AS c_name,
                            CASE WHEN l.o_custkey IS NULL THEN c.c_acctbal ELSE l.bal END AS c_acctbal)
        FROM customer c FULL OUTER JOIN l ON c.c_custkey = l.o_custkey""",
}
