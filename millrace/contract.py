"""The registered queries: one per operator family, each reading the given
tables (or data Spark derives from them) in full, plus the equivalent SQL the
DuckDB oracle runs on the same tables.

Parameters (days, months) come from the data, never from the clock. Queries
that write (exports, partitioned tables, streams) write under the shared
folder named by ``spark.checkpoint.dir`` and return what they read back.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.dates import utc_stamp
from .functions.text import base_name, serial
from .operators import chunks, compare, merge, schema, textparse
from .plans import daily, loads, sqlsteps
from .session import scratch_path, unique_name
from .sources import export, files, tables
from .streaming import intake

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scalar(df: DataFrame):
    return df.first()[0]


# ---------------------------------------------------------------- daily ETL

def etl_args() -> dict:
    """Mapping of the daily sales job onto lineitem x part."""
    return dict(
        fact_key="l_partkey", dim_key="p_partkey", date_col="l_shipdate",
        fact_select={"transaction_id": F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                                   F.col("l_linenumber").cast("string")),
                     "sale_amount": "l_extendedprice"},
        dim_select={"product_name": "p_name", "category": "p_type"},
        filters={"l_returnflag": "A"},
    )


ETL_SCHEMA = "transaction_id string, sale_amount double, product_name string, category string, sale_date date"


def q_daily_etl(spark, sf_dir):
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    day = _scalar(li.agg(F.max(F.to_date("l_shipdate"))))
    return daily.daily_etl(li, part, day, **etl_args())


def q_daily_backfill(spark, sf_dir, days: int = 30):
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    today = _scalar(li.agg(F.max(F.to_date("l_shipdate"))))
    target = scratch_path(spark, "daily_backfill")
    daily.daily_backfill(spark, li, part, target, default_start=today - _dt.timedelta(days=days),
                         today=today, **etl_args())
    return spark.read.schema(ETL_SCHEMA).parquet(target)


def q_latest_date(spark, sf_dir):
    return daily.latest_date(table(spark, sf_dir, "orders"), "o_orderdate", "2024-01-01")


def q_pending_days(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    loaded = ev.agg(F.max(F.to_date("ts")).alias("today")) \
        .select(F.date_sub("today", 9).alias("latest_date"), "today")
    return daily.pending_days(loaded, F.col("today"))


def _orders_by_month(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.withColumn("o_month", F.date_format("o_orderdate", "yyyy-MM"))


ORDERS_COLS = [("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "STRING"),
               ("o_totalprice", "DOUBLE"), ("o_orderdate", "TIMESTAMP_NTZ"), ("o_orderpriority", "STRING")]


def _monthly_table(spark, sf_dir):
    o = _orders_by_month(spark, sf_dir)
    path = scratch_path(spark, "orders_by_month")
    daily.overwrite_partitions(o, path, ["o_month"])
    name = unique_name("orders_by_month")
    tables.register_external(spark, name, path, columns=ORDERS_COLS, partition_by=[("o_month", "STRING")])
    return o, name


def q_overwrite_partition(spark, sf_dir):
    o, name = _monthly_table(spark, sf_dir)
    last = _scalar(o.agg(F.max("o_month")))
    replacement = o.filter((F.col("o_month") == last) & (F.col("o_orderstatus") == "O")).drop("o_month")
    tables.overwrite_partition(spark, replacement, name, {"o_month": last})
    return spark.table(name)


def q_latest_partition(spark, sf_dir):
    _, name = _monthly_table(spark, sf_dir)
    return tables.latest_partition(spark, name)


# ---------------------------------------------------------------- merges

def _customers(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    target = c.filter(F.col("c_mktsegment") != "HOUSEHOLD")
    changed = c.filter(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY"))
    return c, target, changed


def q_upsert_replace(spark, sf_dir):
    _, target, changed = _customers(spark, sf_dir)
    delta = changed.withColumn("c_acctbal", F.col("c_acctbal") + F.lit(100.0))
    return merge.upsert_replace(target, delta, "c_custkey")


def q_upsert_coalesce(spark, sf_dir):
    _, target, changed = _customers(spark, sf_dir)
    delta = changed.select(
        "c_custkey",
        F.concat(F.col("c_name"), F.lit("*")).alias("c_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") + F.lit(100.0)).alias("c_acctbal"),
        F.lit("note").alias("c_note"))
    return merge.upsert_coalesce(target, delta, "c_custkey")


def q_upsert_update(spark, sf_dir):
    _, target, _ = _customers(spark, sf_dir)
    o = table(spark, sf_dir, "orders")
    delta = o.select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("c_mktsegment"),
        "o_orderdate", "o_orderkey")
    return merge.upsert_update(target, delta, "c_custkey", order_by=["o_orderdate", "o_orderkey"])


def q_merge_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_custkey", "o_orderstatus", "o_orderpriority",
                    F.date_format("o_orderdate", "yyyy").alias("o_year"))
    return merge.merge_rows(rows, "o_custkey")


# ---------------------------------------------------------------- order, chunks, pages

def q_page(spark, sf_dir):
    return chunks.page(table(spark, sf_dir, "orders"), 100, 50, "o_orderkey")


def q_assign_chunks(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return chunks.assign_chunks(o, 7, "o_orderkey").select("o_orderkey", "row_index", "chunk_id")


def _export_input(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    run_date = _scalar(o.agg(F.max(F.to_date("o_orderdate"))))
    return o, run_date


def q_export_chunks(spark, sf_dir):
    o, run_date = _export_input(spark, sf_dir)
    out = scratch_path(spark, "export")
    export.export_chunks(o, 7, out, "o_orderkey", run_date)
    return export.manifest(o, out)  # verified from the files written


def q_export_resume(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    out = scratch_path(spark, "export_resume")
    # the resumable flavour names chunks part_N.csv; an interrupted run wrote chunks 1 and 3. What it
    # wrote must stay: its rows say which run they come from
    first, second = (o.withColumn("run", F.lit(n)) for n in ("first", "second"))
    export.export_chunks(first, 5, out, "o_orderkey", naming="part", only_chunks=[1, 3])
    export.export_chunks(second, 5, out, "o_orderkey", naming="part", resume=True)
    columns = ", ".join(f"`{c}` string" for c in second.columns)
    back = spark.read.schema(f"{columns}, file_name string").options(**files.CSV_TIME_OPTIONS).option("header", True).csv(out)
    return back.groupBy("file_name", "run").agg(F.count(F.lit(1)).alias("rows"), F.min(F.col("o_orderkey").cast("long")).alias("first_key"),
                                                F.max(F.col("o_orderkey").cast("long")).alias("last_key"))


def q_batch_ranges(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey")
    return chunks.batch_ranges(p, 9, "p_partkey", key="p_partkey")


def q_row_id(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return chunks.with_row_index(d, "doc_id", "row_id").drop("__total")


# ---------------------------------------------------------------- CSV, schema, tables

def q_csv_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "supplier_csv")
    files.write_csv(table(spark, sf_dir, "supplier"), path)
    return files.read_csv_text(spark, path)


def q_csv_typed_load(spark, sf_dir):
    odd = table(spark, sf_dir, "nation").toDF("n nationkey", "n-name", "n.regionkey")
    path = scratch_path(spark, "nation_csv")
    files.write_csv(odd, path)
    name = unique_name("nation_loaded")
    loads.load_csv_to_table(spark, path, name, policy="int32", location=scratch_path(spark, "nation_table"))
    return spark.table(name)


def q_infer_ddl(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("is_final", F.col("o_orderstatus") == "F")
    path = scratch_path(spark, "orders_csv")
    files.write_csv(o, path)
    return schema.infer_ddl(files.read_csv_typed(spark, path), "int64")


def q_split_rejects(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    text = (F.when(F.col("event_type") == "error", F.lit("n/a"))
            .when(F.col("event_type") == "click", F.concat(F.col("value").cast("string"), F.lit("x")))
            .otherwise(F.col("value").cast("string")))
    raw = ev.select("event_id", text.alias("value"))
    return schema.with_rejects(raw, {"value": "double"})


PART_COLS = [("p_partkey", "BIGINT"), ("p_name", "STRING"), ("p_type", "STRING"),
             ("p_size", "INT"), ("p_retailprice", "DOUBLE")]


def q_external_table(spark, sf_dir):
    path = scratch_path(spark, "part_files")
    files.write_files(table(spark, sf_dir, "part"), path, "parquet", partition_by=["p_brand"])
    name = unique_name("part_ext")
    return tables.register_external(spark, name, path, columns=PART_COLS,
                                    partition_by=[("p_brand", "STRING")])


def q_verify_table(spark, sf_dir):
    return tables.verify_table(table(spark, sf_dir, "lineitem"))


CONFORM_SCHEMA = "c_custkey BIGINT, c_name STRING, c_phone STRING, c_nationkey BIGINT, c_acctbal DOUBLE"


def q_conform(spark, sf_dir):
    return schema.conform(table(spark, sf_dir, "customer"), CONFORM_SCHEMA)


def q_csv_ragged_rows(spark, sf_dir):
    """Headerless CSV with empty cells, short rows and long rows."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")
    line = (F.when(seg == "AUTOMOBILE", F.concat_ws(",", key, F.col("c_name")))
            .when(seg == "BUILDING", F.concat_ws(",", key, F.col("c_name"), seg, F.lit("extra")))
            .when(seg == "FURNITURE", F.concat_ws(",", key, F.lit(""), seg))
            .otherwise(F.concat_ws(",", key, F.col("c_name"), seg)))
    path = scratch_path(spark, "ragged_csv")
    c.select(line.alias("value")).write.text(path)
    df = files.read_csv_text(spark, path, columns=["c_custkey", "c_name", "c_mktsegment"], header=False,
                             keep_corrupt=True)
    return df.select("c_custkey", "c_name", "c_mktsegment",
                     F.col(files.CORRUPT).isNotNull().alias("is_corrupt"))


def q_overwrite_table(spark, sf_dir):
    """A table replaced by a query that reads the same table."""
    path = scratch_path(spark, "customer_table")
    table(spark, sf_dir, "customer").write.parquet(path)
    name = unique_name("customer_tbl")
    tables.register_external(spark, name, path)
    updated = spark.table(name).withColumn("c_acctbal", F.col("c_acctbal") + F.lit(1.0))
    tables.overwrite_table(spark, updated, name)
    return spark.table(name)


def q_copy_day(spark, sf_dir):
    """One day's landing folder copied into the target under ingest_date."""
    ev = table(spark, sf_dir, "events")
    root = scratch_path(spark, "landing")
    ev.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).write.partitionBy("day").parquet(f"{root}/events")
    day = _scalar(ev.agg(F.date_format(F.max("ts"), "yyyy-MM-dd")))
    files.copy_day(spark, f"{root}/events/day={day}", f"{root}/copied", day)
    return spark.read.parquet(f"{root}/copied")


SUPPLIER_DDL = [("s_suppkey", "BIGINT"), ("s_name", "VARCHAR(25)"), ("s_nationkey", "INT"),
                ("s_acctbal", "DOUBLE")]


def q_ddl_table(spark, sf_dir):
    """Database + pipe-delimited CSV table from a (name, type) list, loaded by position."""
    db = unique_name("millrace_db")
    name = tables.create_table(spark, "supplier_copy", SUPPLIER_DDL, database=db, replace=True,
                               database_location=scratch_path(spark, "db"), fmt="csv", delimiter="|",
                               location=scratch_path(spark, "supplier_pipe"), comment="supplier copy")
    tables.load_table(table(spark, sf_dir, "supplier"), name)
    return spark.table(name)


def q_create_like(spark, sf_dir):
    """An empty clone of a table's structure, then loaded."""
    c = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer_src")
    c.write.parquet(path)
    src = unique_name("customer_src")
    tables.register_external(spark, src, path)
    clone = unique_name("customer_like")
    tables.create_like(spark, clone, src, location=scratch_path(spark, "customer_like"))
    tables.load_table(c, clone)
    return spark.table(clone)


def q_load_overwrite(spark, sf_dir):
    """Appends then an overwrite load: the table ends with the last load only."""
    n = table(spark, sf_dir, "nation")
    name = tables.create_table(spark, unique_name("nation_loads"),
                               [("n_nationkey", "INT"), ("n_name", "STRING"), ("n_regionkey", "INT")],
                               location=scratch_path(spark, "nation_loads"))
    tables.load_table(n, name, "append")
    tables.load_table(n, name, "append")
    tables.load_table(n.filter(F.col("n_regionkey") == 1), name, "overwrite")
    return spark.table(name)


# ---------------------------------------------------------------- pipe records and layouts

PIPE_COLUMNS = ["ID", "PROCESS_NAME", "DSSTATUS", "DSDAY", "DSPRICE", "DSLINK", "DSREF"]


def order_lines(o: DataFrame) -> DataFrame:
    """Pipe records made from orders: some keys missing by rule, one key
    outside the layout, one unknown token, the last value without extra."""
    s = lambda c: F.col(c).cast("string")
    parts = [
        F.lit("ID"), s("o_orderkey"), F.lit("PROCESS_NAME"), F.col("o_orderpriority"),
        F.when(F.col("o_orderpriority") != "5-LOW",
               F.concat_ws("|", F.lit("DSSTATUS"), F.col("o_orderstatus"), s("o_custkey"))),
        F.concat_ws("|", F.lit("DSDAY"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus")),
        F.lit("ZZ"),
        F.concat_ws("|", F.lit("DSPRICE"), F.floor("o_totalprice").cast("long").cast("string"), F.lit("P")),
        F.concat_ws("|", F.lit("DSNOTE"), F.lit("a"), F.lit("b")),
        F.when(F.col("o_orderstatus") != "P",
               F.concat_ws("|", F.lit("DSLINK"), s("o_custkey"), s("o_orderkey"))),
        F.concat_ws("|", F.lit("DSREF"), s("o_orderkey")),
    ]
    return o.select("o_orderkey", F.concat_ws("|", *parts).alias("line"))


def q_parse_pipe_records(spark, sf_dir):
    lines = order_lines(table(spark, sf_dir, "orders"))
    path = scratch_path(spark, "pipe_text")
    lines.orderBy("o_orderkey").select("line").write.text(path)
    return textparse.read_pipe_records(spark, path, PIPE_COLUMNS)


def _xml_text(c):
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def nation_layouts(spark, sf_dir) -> DataFrame:
    """One XML layout document per region listing its nations as fields."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    fields = n.select("n_regionkey", F.struct(
        "n_nationkey", F.concat(F.lit("<field><name>"), _xml_text(F.col("n_name")),
                                F.lit("</name></field>")).alias("x")).alias("f"))
    docs = r.join(fields, r["r_regionkey"] == fields["n_regionkey"], "left").groupBy("r_regionkey").agg(
        F.concat(F.lit("<bulkData>"),
                 F.array_join(F.transform(F.sort_array(F.collect_list("f")), lambda f: f["x"]), ""),
                 F.lit("</bulkData>")).alias("doc"))
    return docs.select(F.col("r_regionkey").alias("layout_id"), "doc")


def q_xml_layout(spark, sf_dir):
    docs = nation_layouts(spark, sf_dir)
    layouts = docs.select("layout_id", textparse.layout_columns(F.col("doc")).alias("columns"))
    return textparse.layout_rows(layouts, "layout_id")


def q_xml_layout_exclude(spark, sf_dir):
    docs = nation_layouts(spark, sf_dir)
    layouts = docs.select("layout_id", textparse.layout_columns(
        F.col("doc"), exclude=["NATION_0"], malformed_fixed=False).alias("columns"))
    return textparse.layout_rows(layouts, "layout_id")


def region_layout(spark, sf_dir) -> DataFrame:
    """A single layout document with one field per region: the keys of :func:`order_lines`."""
    r = table(spark, sf_dir, "region")
    f = r.select(F.struct("r_regionkey", F.concat(
        F.lit("<field><name>"), F.get(F.array(*[F.lit(c) for c in PIPE_COLUMNS[2:]]), F.col("r_regionkey").cast("int")),
        F.lit("</name></field>")).alias("x")).alias("f"))
    return f.agg(F.concat(F.lit("<bulkData>"),
                          F.array_join(F.transform(F.sort_array(F.collect_list("f")), lambda x: x["x"]), ""),
                          F.lit("</bulkData>")).alias("doc"))


def q_load_by_layout(spark, sf_dir):
    layout = region_layout(spark, sf_dir).select(
        textparse.layout_columns(F.col("doc"), exclude=["DSPRICE"]).alias("columns"))
    lines = order_lines(table(spark, sf_dir, "orders"))
    return textparse.load_by_layout(lines, "line", layout, order_by="o_orderkey")


# ---------------------------------------------------------------- reconciliation and files

def _doc_name(c):
    return F.concat(F.lit("doc_"), F.col(c).cast("string"), F.lit(".txt"))


def q_presence_matrix(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    a = d.filter(F.col("lang").isin("en", "de")).select(_doc_name("doc_id").alias("file_name"))
    b = d.filter(F.col("lang").isin("de", "fr", "es") & (F.col("source") != "src0")) \
        .select(_doc_name("doc_id").alias("file_name"))
    return compare.presence_matrix(a, b)


def q_compare_datasets(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    bench = table(spark, sf_dir, "benchmark")
    left = d.select(_doc_name("doc_id").alias("file_name"), "text")
    changed = (F.when(F.col("lang") == "en", F.concat(F.regexp_replace("text", " ", "  "), F.lit("\n\n")))
               .when(F.col("lang") == "de", F.concat(F.col("text"), F.lit(" extra")))
               .otherwise(F.regexp_replace("text", "\n", "\n \t\n")))
    right = d.filter(F.col("lang") != "fr").select(_doc_name("doc_id").alias("file_name"), changed.alias("text")) \
        .unionByName(bench.select(F.concat(F.lit("bench_"), F.col("item_id").cast("string"),
                                           F.lit(".txt")).alias("file_name"), "text"))
    return compare.compare_datasets(left, right)


def q_count_files(spark, sf_dir):
    """Files per extension in a tree written from part: each table is
    clustered on its partition column first, so every partition folder holds
    exactly one file and the counts follow the data."""
    root = scratch_path(spark, "file_counts")
    p = table(spark, sf_dir, "part")
    p.repartition("p_brand").write.partitionBy("p_brand").option("header", True).csv(f"{root}/csv")
    p.repartition("p_type").write.partitionBy("p_type").parquet(f"{root}/parquet")
    p.repartition("p_size").write.partitionBy("p_size").json(f"{root}/nested/json")
    return files.count_files(spark, root)


def q_pending_files(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    listing = pages.select("page_id", F.col("url").alias("path"))
    ledger = pages.filter(F.col("url").contains("/en/")).select(F.col("url").alias("path"))
    return intake.pending_files(listing, ledger, "path")


STEPS_SCRIPT = """
-- @label: recent_orders
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority
FROM orders
WHERE o_orderdate >= :start_date

-- @label: by_segment
SELECT c.c_mktsegment, r.o_orderpriority,
       count(*) AS n_orders, max(r.o_totalprice) AS max_price
FROM recent_orders r JOIN customer c ON r.o_custkey = c.c_custkey
GROUP BY c.c_mktsegment, r.o_orderpriority

-- @label: notes
-- kept for the runbook; nothing to run
"""


def q_run_sql_steps(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    start = _scalar(o.agg(F.max(F.to_date("o_orderdate")))) - _dt.timedelta(days=365)
    return sqlsteps.run_sql_steps(spark, STEPS_SCRIPT, args={"start_date": start},
                                  views={"orders": o, "customer": table(spark, sf_dir, "customer")})


def q_ingest_stream(spark, sf_dir):
    """CSV files with a header land in a folder; the stream takes them in
    micro-batches and keeps the latest event per user."""
    ev = table(spark, sf_dir, "events")
    root = scratch_path(spark, "intake")
    files.write_csv(ev.repartitionByRange(10, "ts"), f"{root}/incoming")
    intake.ingest_files(spark, f"{root}/incoming", ev.schema, fmt="csv",
                        options={"header": "true", **files.CSV_TIME_OPTIONS},
                        state_dir=f"{root}/state", archive_dir=f"{root}/archive",
                        checkpoint_dir=f"{root}/checkpoint", keys=["user_id"],
                        order_by=["ts", "event_id"], max_files_per_trigger=5,
                        reject_dir=f"{root}/rejects", ledger_dir=f"{root}/ledger")
    intake.compact_state(spark, f"{root}/state", f"{root}/compacted", ["user_id"], ["ts", "event_id"])
    return spark.read.parquet(f"{root}/compacted")


def q_scalar_formats(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    path = F.concat(F.lit("s3a://landing/in/"), F.col("o_orderstatus"), F.lit("/"),
                    F.col("o_orderkey").cast("string"), F.lit(".csv"))
    return o.select(
        "o_orderkey",
        F.regexp_extract("o_orderpriority", r"^(\d+)-", 1).alias("priority_code"),
        F.regexp_replace("o_orderpriority", r"^\d+-", "").alias("priority_label"),
        F.upper("o_orderpriority").startswith("1-").alias("is_urgent"),
        F.translate("o_orderpriority", " -.", "___").alias("clean_label"),
        F.trim(F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit(" "))).alias("status_trim"),
        F.concat(F.col("o_orderstatus"), F.lit("-"), F.col("o_custkey").cast("string")).alias("value_extra"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("order_day_compact"),
        F.date_add(F.to_date("o_orderdate"), 1).alias("next_day"),
        utc_stamp("o_orderdate", wall_clock=True).alias("stamp_utc"),
        serial(F.month("o_orderdate")).alias("month_serial"),
        serial(F.col("o_orderkey") % 1000).alias("key_serial"),
        F.ceil(F.col("o_totalprice") / 1000).alias("price_bucket"),
        F.expr("o_orderkey div 7").alias("key_div"),
        (F.col("o_orderkey") % 7).alias("key_mod"),
        base_name(path).alias("file_name"),
        F.concat(base_name(path), F.lit(".updated")).alias("marked_name"),
        F.concat(F.lit("/data/sales/"), F.date_format("o_orderdate", "yyyy/MM/dd")).alias("day_path"),
        F.coalesce(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit("none")).alias("priority_or_none"),
    )


# ---------------------------------------------------------------- registry

QUERIES: dict[str, Query] = {
    "daily_etl": q_daily_etl,
    "daily_backfill": q_daily_backfill,
    "latest_date": q_latest_date,
    "pending_days": q_pending_days,
    "overwrite_partition": q_overwrite_partition,
    "latest_partition": q_latest_partition,
    "upsert_replace": q_upsert_replace,
    "upsert_coalesce": q_upsert_coalesce,
    "upsert_update": q_upsert_update,
    "merge_rows": q_merge_rows,
    "page": q_page,
    "assign_chunks": q_assign_chunks,
    "export_chunks": q_export_chunks,
    "export_resume": q_export_resume,
    "batch_ranges": q_batch_ranges,
    "row_id": q_row_id,
    "csv_text_roundtrip": q_csv_text_roundtrip,
    "csv_typed_load": q_csv_typed_load,
    "csv_ragged_rows": q_csv_ragged_rows,
    "overwrite_table": q_overwrite_table,
    "copy_day": q_copy_day,
    "ddl_table": q_ddl_table,
    "create_like": q_create_like,
    "load_overwrite": q_load_overwrite,
    "infer_ddl": q_infer_ddl,
    "split_rejects": q_split_rejects,
    "external_table": q_external_table,
    "verify_table": q_verify_table,
    "conform": q_conform,
    "parse_pipe_records": q_parse_pipe_records,
    "xml_layout": q_xml_layout,
    "xml_layout_exclude": q_xml_layout_exclude,
    "load_by_layout": q_load_by_layout,
    "presence_matrix": q_presence_matrix,
    "compare_datasets": q_compare_datasets,
    "count_files": q_count_files,
    "pending_files": q_pending_files,
    "run_sql_steps": q_run_sql_steps,
    "ingest_stream": q_ingest_stream,
    "scalar_formats": q_scalar_formats,
}
