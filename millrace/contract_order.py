"""Registered queries of numbering, paging and listing at scale, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contract import PIPE_COLUMNS, order_lines, table
from .operators import chunks, lattice, schema, textparse
from .oracle import pipe_sql
from .session import scratch_path, written
from .sources import files
from .sources.csvsplit import read_csv_by_header


def q_row_id_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of lineitem numbered by an order of a few values (ties go by row hash): what each value gets."""
    li = chunks.with_row_index(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "row_id")
    # distinct numbers are counted exactly, by a bitmap for each 32768 of them: no task holds a row for each number
    per = li.groupBy("l_returnflag", "l_linestatus", F.bitmap_bucket_number("row_id").alias("bucket")).agg(
        F.min("row_id").alias("first_id"), F.max("row_id").alias("last_id"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("row_id"))).alias("ids"),
        F.max("__total").alias("total"), F.sum("l_extendedprice").alias("price"))
    return per.groupBy("l_returnflag", "l_linestatus").agg(
        F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"), F.sum("ids").alias("ids"),
        F.max("total").alias("total"), F.round(F.sum("price"), 2).alias("price"))


def q_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page of lineitem that begins at nine tenths of its rows."""
    li = table(spark, sf_dir, "lineitem")
    return chunks.deep_page(li, li.count() * 9 // 10, 250, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def q_pipe_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe records in one file per order date, numbered through all files in order."""
    o = table(spark, sf_dir, "orders")
    lines = order_lines(o).join(o.select("o_orderkey", F.to_date("o_orderdate").alias("day")), "o_orderkey")
    path = scratch_path(spark, "pipe_files")
    lines.repartition("day").sortWithinPartitions("day", "o_orderkey").select("line", "day").write.partitionBy("day").text(path)
    return textparse.read_pipe_records(spark, path, PIPE_COLUMNS)


def q_count_hidden_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per extension in a tree with hidden names: one file per brand, every second folder hidden."""
    root = scratch_path(spark, "hidden_files")
    p = table(spark, sf_dir, "part")
    brand = F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")
    odd = F.pmod(F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int"), F.lit(2)) == 1
    for hidden in (False, True):
        rows = p.where(odd if hidden else ~odd).withColumn("brand", brand)
        rows.repartition("brand").write.partitionBy("brand").option("header", True).csv(f"{root}/top/{'_hidden' if hidden else 'plain'}")
    # the writer leaves one marker of success per table (no extension), and no other file
    return files.count_files(spark, root, hidden=True).where("ext != 'crc'")


def q_infer_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of columns whose last rows change them, under each policy, from one reading of the CSV."""
    o = table(spark, sf_dir, "orders")
    last = o.agg(F.max("o_orderkey")).first()[0]
    late = F.col("o_orderkey") == last
    text = F.col("o_orderkey").cast("string")
    rows = o.select(
        text.alias("whole"), F.when(late, "n/a").otherwise(text).alias("late text"), F.when(late, "0.5").otherwise(text).alias("late decimal"),
        F.when(late, "3000000000").otherwise(text).alias("late long"), (F.col("o_orderstatus") == "F").cast("string").alias("flag"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(late, "2024-01-01 10:00:00").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("late time"),
        F.when(late, "true").otherwise(text).alias("mixed"), F.lit("").alias("empty"))
    path = scratch_path(spark, "late_types")
    files.write_csv(rows.orderBy("o_orderkey"), path)
    read, _ = read_csv_by_header(spark, path)
    found = lattice.column_types(written(read, "csv-text"))
    out = [(policy, i + 1, c.name, c.ddl(policy), c.cells) for policy in schema.POLICIES for i, c in enumerate(found)]
    return spark.createDataFrame(out, "policy string, ordinal int, column_name string, data_type string, cells long")


QUERIES = {"row_id_wide": q_row_id_wide, "page_deep": q_page_deep, "pipe_many_files": q_pipe_many_files,
           "count_hidden_files": q_count_hidden_files, "infer_lattice": q_infer_lattice}

ORACLE_SQL: dict[str, str] = {
    "row_id_wide": """
        WITH r AS (SELECT *, row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS row_id, count(*) OVER () AS total FROM lineitem)
        SELECT l_returnflag, l_linestatus, min(row_id) AS first_id, max(row_id) AS last_id, count(DISTINCT row_id) AS ids,
               max(total) AS total, round(sum(l_extendedprice), 2) AS price
        FROM r GROUP BY ALL""",
    "page_deep": """
        WITH r AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS rn, count(*) OVER () AS n FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM r
        WHERE rn > n * 9 // 10 AND rn <= n * 9 // 10 + 250""",
    "count_hidden_files": """
        SELECT 'csv' AS ext, count(DISTINCT regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) AS files FROM part
        UNION ALL SELECT '', 2""",
    "infer_lattice": """
        WITH n AS (SELECT count(*) AS n FROM orders),
        c(ordinal, column_name, t32, t64, tts) AS (VALUES
            (1, 'whole', 'INT', 'BIGINT', 'BIGINT'), (2, 'late text', 'STRING', 'STRING', 'STRING'), (3, 'late decimal', 'DOUBLE', 'DOUBLE', 'DOUBLE'),
            (4, 'late long', 'BIGINT', 'BIGINT', 'BIGINT'), (5, 'flag', 'BOOLEAN', 'BOOLEAN', 'BOOLEAN'), (6, 'day', 'STRING', 'STRING', 'TIMESTAMP'),
            (7, 'late time', 'STRING', 'STRING', 'TIMESTAMP'), (8, 'mixed', 'STRING', 'STRING', 'STRING'), (9, 'empty', 'STRING', 'STRING', 'STRING'))
        SELECT p.policy, c.ordinal, c.column_name, CASE p.policy WHEN 'int32' THEN t32 WHEN 'int64' THEN t64 ELSE tts END AS data_type,
               CASE WHEN c.column_name = 'empty' THEN 0 ELSE n.n END AS cells
        FROM c, n, (VALUES ('int32'), ('int64'), ('int64_ts')) AS p(policy)""",
    "pipe_many_files": pipe_sql(PIPE_COLUMNS[1:], order="CAST(o_orderdate AS DATE), o_orderkey"),
}
