"""Registered queries of CSV intake and snapshot tables, each with its DuckDB SQL."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .contract import ETL_SCHEMA, etl_args, table
from .oracle import ETL_SELECT, MAX_SHIP
from .plans import daily
from .session import scratch_path, written
from .sources import files
from .sources.csvsplit import read_csv_by_header
from .sources.snapshots import Folder, KeyedTable, SnapshotTable
from .streaming.merge_intake import Intake, Target, ledger, replay


#: Text that one task writes into one CSV file.
FILE_BYTES = 512 << 20


def _write_lines(df: DataFrame, line: Column, header: str, path: str) -> None:
    """Ready-made CSV lines under a header, as other programs write them (rows may be short)."""
    df.select(line.alias(header)).write.option("header", True).option("sep", "\x01").csv(path)


def q_csv_split_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in one CSV file (one for each ``FILE_BYTES`` of text), quotes and line breaks in its cells, read by many tasks."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit('say "'), F.col("lang"), F.lit('"\n\n'), F.col("text")).alias("text"), "source")
    path = scratch_path(spark, "one_file")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files.write_csv(docs.coalesce(max(1, -(-size // FILE_BYTES))), path)  # few files of many splits each are the point
    rows, _ = read_csv_by_header(spark, path, columns=["doc_id", "text", "source"])
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source")


def q_csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of files with other orders and choices of columns; unknown headers are set aside."""
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "mixed_headers")
    shapes = {"F": ["o_orderkey", "o_custkey", "o_totalprice"], "O": ["o_totalprice", "o_orderkey", "o_orderpriority", "o_custkey"],
              "P": ["o_custkey", "o_orderkey"]}
    for status, columns in shapes.items():
        files.write_csv(o.where(F.col("o_orderstatus") == status).select(columns), f"{path}/{status}")
    files.write_csv(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), f"{path}/other")
    rows, rejects = read_csv_by_header(spark, path, columns=["o_orderkey", "o_custkey", "o_totalprice"], required=["o_orderkey"])
    rows = rows.select(F.lit("row").alias("kind"), F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"),
                       F.col("o_totalprice").cast("double"), F.lit(None).cast("string").alias("record"))
    return rows.unionByName(rejects.select(F.col("reason").alias("kind"), F.lit(None).cast("long").alias("o_orderkey"),
                                           F.lit(None).cast("long").alias("o_custkey"), F.lit(None).cast("double").alias("o_totalprice"), "record"))


def q_copy_day_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV day of documents (quotes, line breaks, blanks) copied into the target under ingest_date."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.concat(F.lit(' "'), F.col("text"), F.lit('"\n ')).alias("text"))
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "days")
    files.write_csv(docs, landing)
    files.copy_day(spark, landing, target, "2024-03-01", fmt="csv")
    files.copy_day(spark, landing, target, "2024-03-01", fmt="csv")  # replaces the day
    rows, _ = read_csv_by_header(spark, f"{target}/ingest_date=2024-03-01", columns=["doc_id", "text"])
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


_KEPT = "o_custkey long, o_orderkey long, status string, total double"


class _FailsOnce(KeyedTable):
    """A target that is away at its first merge."""

    away = True

    def merge(self, *args, **kwargs):
        if self.away:
            self.away = False
            raise ConnectionError("the second target is away")
        return super().merge(*args, **kwargs)


def _waves(spark: SparkSession, sf_dir: str, landing: str, wave: int) -> None:
    """Orders of odd or even keys as CSV: empty cells, short rows, columns in another order each time."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 2 == wave)
    key, number = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    status = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    total = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_totalprice").cast("string"))
    cells = [key, number, status, total] if wave else [total, status, number, key]
    short = F.col("o_orderkey") % 50 < 2
    line = F.when(short, F.concat_ws(",", *cells[:-1])).otherwise(F.concat_ws(",", *cells))
    _write_lines(o, line, "o_custkey,o_orderkey,status,total" if wave else "total,status,o_orderkey,o_custkey", f"{landing}/wave{wave}")


def q_ingest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the intake on one checkpoint; in the first the second target fails and is
    tried again. Both targets in the end, one row per key each."""
    base = scratch_path(spark, "ingest_merge")
    schema = StructType.fromDDL(_KEPT)
    first = KeyedTable(spark, f"{base}/first", schema, "o_custkey", buckets=8)
    second = _FailsOnce(spark, f"{base}/second", schema, "o_custkey", buckets=8)
    intake = Intake(spark, [Target(first, "coalesce"), Target(second, "update")], order_by=["o_orderkey"],
                    ledger_dir=f"{base}/ledger", reject_dir=f"{base}/rejects")
    for wave in (0, 1):
        _waves(spark, sf_dir, f"{base}/landing", wave)
        for _ in range(2):
            try:
                intake.stream(f"{base}/landing", checkpoint_dir=f"{base}/checkpoint", max_files_per_trigger=100_000)
                break
            except Exception as e:  # the stream stops with the target's error; the next run takes the batch again
                if "the second target is away" not in str(e):
                    raise
    out = first.rows().withColumn("target", F.lit("first")).unionByName(second.rows().withColumn("target", F.lit("second")))
    short = ledger(spark, f"{base}/ledger").agg(F.sum("rejected").alias("o_custkey")).select(
        "o_custkey", F.lit(None).cast("long").alias("o_orderkey"), F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("double").alias("total"), F.lit("rejected").alias("target"))
    return out.unionByName(short)


def q_ingest_bad_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with a file that cannot be read and one with an open quote: the others are loaded,
    each file has its status, and the second one is mended and taken again."""
    base = scratch_path(spark, "ingest_bad")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    for odd in (0, 1):
        files.write_csv(s.where((F.col("s_nationkey") % 2 == odd) & (F.col("s_nationkey") > 0)), f"{base}/landing/{odd}")
    landing = Folder(spark, f"{base}/landing")
    landing.write_new("broken.csv.gz", "no gzip at all")
    mended = s.where("s_nationkey = 0").agg(F.concat_ws("\n", F.sort_array(F.collect_list(  # one nation's suppliers
        F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string")))))).first()[0]
    landing.write_new("open.csv", f's_suppkey,s_name,s_nationkey\n{mended}\n"')
    stored = KeyedTable(spark, f"{base}/suppliers", StructType.fromDDL("s_suppkey long, s_name string, s_nationkey int"), "s_suppkey", buckets=4)
    intake = Intake(spark, [Target(stored, "update")], order_by=["s_nationkey"], ledger_dir=f"{base}/ledger", reject_dir=f"{base}/rejects")
    intake.stream(f"{base}/landing", checkpoint_dir=f"{base}/checkpoint", max_files_per_trigger=100_000)

    def statuses(when: str) -> DataFrame:
        every = ledger(spark, f"{base}/ledger").where("status != 'loaded'")
        return every.select(F.lit(when).alias("kind"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("status").alias("what"),
                            F.lit(None).cast("long").alias("s_suppkey"))

    before = written(statuses("before"), "statuses")  # the ledger as it is now
    landing.delete("open.csv")
    landing.write_new("open.csv", f"s_suppkey,s_name,s_nationkey\n{mended}\n")
    replay(intake, [f"{base}/landing/open.csv"])
    rows = stored.rows().select(F.lit("row").alias("kind"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("what"), "s_suppkey")
    return rows.unionByName(before).unionByName(statuses("after"))


def q_backfill_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty days loaded at once, the last ten loaded again without one of them: both snapshots."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    today = li.agg(F.max(F.to_date("l_shipdate"))).first()[0]
    target = SnapshotTable(spark, scratch_path(spark, "backfill_snapshot"), "sale_date")
    daily.backfill_snapshot(li, part, target, default_start=today - _dt.timedelta(days=30), today=today, **etl_args())
    late = li.where(F.to_date("l_shipdate") != F.lit(today - _dt.timedelta(days=3)))
    daily.backfill_snapshot(late, part, target, default_start=today, today=today, lookback_days=10, **etl_args())
    schema = StructType.fromDDL(ETL_SCHEMA)
    return target.read(1, schema=schema).withColumn("snapshot", F.lit(1)).unionByName(target.read(schema=schema).withColumn("snapshot", F.lit(2)))


QUERIES = {
    "csv_split_quotes": q_csv_split_quotes,
    "csv_mixed_headers": q_csv_mixed_headers,
    "copy_day_csv": q_copy_day_csv,
    "ingest_merge": q_ingest_merge,
    "ingest_bad_file": q_ingest_bad_file,
    "backfill_snapshot": q_backfill_snapshot,
}

_LAST = "last({c} ORDER BY wave, o_orderkey)"

ORACLE_SQL: dict[str, str] = {
    "csv_split_quotes": "SELECT doc_id, coalesce('say \"' || lang || '\"' || chr(10) || chr(10) || text, '') AS text, coalesce(source, '') AS source FROM documents",
    "csv_mixed_headers": """
        SELECT 'row' AS kind, o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
               CAST(NULL AS VARCHAR) AS record
        FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
        UNION ALL
        SELECT 'header', NULL, NULL, NULL, CAST(s_suppkey AS VARCHAR) || ',' || s_name FROM supplier""",
    "copy_day_csv": "SELECT doc_id, coalesce(' \"' || text || '\"' || chr(10) || ' ', '') AS text FROM documents",
    "ingest_merge": f"""
        WITH r AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS status,
                          CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS total, o_orderkey % 2 AS wave
                   FROM orders WHERE o_orderkey % 50 >= 2)
        SELECT o_custkey, {_LAST.format(c='o_orderkey')} AS o_orderkey, {_LAST.format(c='status')} AS status,
               {_LAST.format(c='total')} FILTER (WHERE total IS NOT NULL) AS total, 'first' AS target
        FROM r GROUP BY o_custkey
        UNION ALL
        SELECT o_custkey, {_LAST.format(c='o_orderkey')}, {_LAST.format(c='status')}, {_LAST.format(c='total')}, 'second'
        FROM r GROUP BY o_custkey
        UNION ALL
        SELECT count(*), NULL, NULL, NULL, 'rejected' FROM orders WHERE o_orderkey % 50 < 2""",
    "ingest_bad_file": """
        SELECT 'row' AS kind, s_name AS name, CAST(s_nationkey AS VARCHAR) AS what, s_suppkey FROM supplier
        UNION ALL
        SELECT * FROM (VALUES ('before', 'broken.csv.gz', 'unreadable', CAST(NULL AS BIGINT)), ('before', 'open.csv', 'quotes', NULL),
                              ('after', 'broken.csv.gz', 'unreadable', NULL)) AS f(kind, name, what, s_suppkey)""",
    "backfill_snapshot": f"""
        WITH e AS ({ETL_SELECT}  AND CAST(l.l_shipdate AS DATE) BETWEEN {MAX_SHIP} - 29 AND {MAX_SHIP})
        SELECT *, 1 AS snapshot FROM e
        UNION ALL
        SELECT *, 2 FROM e WHERE sale_date <> {MAX_SHIP} - 3""",
}
