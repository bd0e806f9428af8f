"""Registered queries of whole flows and checks: the one-day pipeline, layout documents and scripts
read from disk, a write read back, suffix rules, delta reports, each with its DuckDB SQL."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contract import ETL_SCHEMA, etl_args, nation_layouts, table
from .operators import merge, textparse
from .oracle import ETL_SELECT, MAX_SHIP
from .oracle import ORACLE_SQL as BASE_SQL
from .plans import daily, sqlsteps
from .session import scratch_path
from .sources import files, tables
from .sources.snapshots import SnapshotTable


def q_run_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last three days, each by the one-day pipeline; the second one twice."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    base = scratch_path(spark, "run_day")
    today = li.agg(F.max(F.to_date("l_shipdate"))).first()[0]
    days = [today - _dt.timedelta(days=n) for n in (2, 1, 1, 0)]
    li.where(F.to_date("l_shipdate") >= F.lit(days[0])).withColumn("day", F.to_date("l_shipdate")).write.partitionBy("day").parquet(f"{base}/landing")
    target = SnapshotTable(spark, f"{base}/target", "sale_date")
    for day in days:
        daily.run_day(spark, f"{base}/landing/day={day.isoformat()}", f"{base}/facts", part, target, day, **etl_args())
    return target.read().select([f.split()[0] for f in ETL_SCHEMA.split(", ")])


def q_read_xml_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One layout document per region, read from files."""
    path = scratch_path(spark, "layouts")
    docs = nation_layouts(spark, sf_dir)
    columns = docs.columns
    docs.select(F.col(columns[-1]).alias("value"), F.col(columns[0]).alias("layout_id")).repartition("layout_id").write.partitionBy("layout_id").text(path)
    read = textparse.read_xml_layout(spark, path)
    names = read.select(F.regexp_extract("path", "layout_id=([0-9]+)/", 1).cast("int").alias("layout_id"), F.posexplode("columns").alias("pos", "column_name"))
    return names.select("layout_id", (F.col("pos") + 1).cast("long").alias("pos"), "column_name")


def q_write_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written and read back: the report, and what the first five rows are."""
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "read_back")
    files.write_files(o, path)
    back = spark.read.parquet(path)
    first = tables.sample_rows(back, 5)
    held = first.join(o.select("o_orderkey"), "o_orderkey", "left_semi").agg(F.count(F.lit(1)).alias("first_rows"))
    return tables.verify_table(back).join(F.broadcast(held))  # one row each


def q_suffix_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by suffix: only names that end in .csv, none that was marked as done or updated."""
    path = scratch_path(spark, "suffixes")
    p = table(spark, sf_dir, "part").repartition("p_brand")
    for name in ("a.csv", "b.csv.done", "c.csv.updated", "d.CSV"):
        p.select("p_brand", "p_name").write.partitionBy("p_brand").text(f"{path}/{name}")
    every = files.list_tree(spark, path).where("file_name like 'part-%.txt'")
    return every.select(F.regexp_extract("path", "/([abcd][.][^/]*)/", 1).alias("name")).where(F.col("name").endswith(".csv")).groupBy("name").agg(
        F.count(F.lit(1)).alias("files"))


def q_delta_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether deltas can be merged: a good one with null keys, an empty one, one without its key."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    good = o.select(F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("c_custkey"))
    out = [("good", good), ("empty", good.where(F.lit(False))), ("other", o)]
    reports = [merge.delta_report(c, d, "c_custkey").withColumn("delta", F.lit(n)) for n, d in out]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


_SCRIPT = """
-- customers; by segment
CREATE OR REPLACE TEMPORARY VIEW {v} AS SELECT c_mktsegment, count(*) AS n, 'it\\'s; one' AS note FROM {c} GROUP BY 1; /* a; b */
SELECT c_mktsegment, n, note, "semi;colon" AS mark FROM {v};
"""


def q_statement_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script of statements with semicolons in escaped strings and comments."""
    view, source = "script_result", "script_customers"
    table(spark, sf_dir, "customer").createOrReplaceTempView(source)
    return sqlsteps.run_sql_steps(spark, _SCRIPT.format(v=view, c=source), style="statements")


QUERIES = {"run_day": q_run_day, "read_xml_layouts": q_read_xml_layouts, "write_read_back": q_write_read_back, "suffix_listing": q_suffix_listing,
           "delta_reports": q_delta_reports, "statement_script": q_statement_script}

ORACLE_SQL: dict[str, str] = {
    "read_xml_layouts": BASE_SQL["xml_layout"],
    "run_day": ETL_SELECT + f"  AND CAST(l.l_shipdate AS DATE) >= {MAX_SHIP} - 2",
    "write_read_back": """
        SELECT count(*) AS row_count, 6 AS n_columns, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS column_list,
               CAST(5 AS BIGINT) AS first_rows FROM orders""",
    "suffix_listing": "SELECT 'a.csv' AS name, count(DISTINCT p_brand) AS files FROM part",
    "delta_reports": """
        SELECT 'ok' AS status, count(*) AS rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS null_keys, 'good' AS delta FROM orders
        UNION ALL SELECT 'empty', 0, 0, 'empty'
        UNION ALL SELECT 'no key', count(*), 0, 'other' FROM orders""",
    "statement_script": """
        SELECT c_mktsegment, count(*) AS n, 'it''s; one' AS note, 'semi;colon' AS mark FROM customer GROUP BY 1""",
}
