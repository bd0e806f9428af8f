"""Equivalent SQL for each registered query, written for DuckDB over the same
tables (views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations``). Column names
match the Spark results.
"""

from __future__ import annotations

ETL_SELECT = """
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
       l.l_extendedprice AS sale_amount, p.p_name AS product_name, p.p_type AS category,
       CAST(l.l_shipdate AS DATE) AS sale_date
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_returnflag = 'A'
"""

MAX_SHIP = "(SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)"

_ORDERS_BY_MONTH = """
WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS o_month FROM orders),
     m AS (SELECT max(o_month) AS mm FROM o)
"""

_CUSTOMERS = """
t AS (SELECT * FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
changed AS (SELECT * FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY'))
"""

_CHUNKS = """
WITH r AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders),
     c AS (SELECT CAST(floor((rn - 1) / ceil(n / {n}.0)) + 1 AS INTEGER) AS chunk FROM r)
SELECT strftime((SELECT max(o_orderdate) FROM orders), '%Y%m%d') || '-' || printf('%02d', chunk) || '.csv'
       AS file_name, count(*) AS rows
FROM c GROUP BY chunk
"""

_PIPE_COLS = {
    "PROCESS_NAME": "o_orderpriority",
    "DSSTATUS": "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus || '-' || CAST(o_custkey AS VARCHAR) END",
    "DSDAY": "strftime(o_orderdate, '%Y-%m-%d') || '-' || o_orderstatus",
    "DSPRICE": "CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '-P'",
    "DSLINK": "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR) END",
    "DSREF": "CAST(o_orderkey AS VARCHAR)",
}


def pipe_sql(columns: list[str], order: str = "o_orderkey") -> str:
    cols = [f"row_number() OVER (ORDER BY {order}) AS \"ID\""]
    cols += [f"{_PIPE_COLS[c]} AS \"{c}\"" for c in columns]
    return "SELECT " + ",\n       ".join(cols) + "\nFROM orders"


def _layout_sql(exclude: str | None) -> str:
    where = f"WHERE n_name <> '{exclude}'" if exclude else ""
    return f"""
SELECT r_regionkey AS layout_id, CAST(1 AS BIGINT) AS pos, 'ID' AS column_name FROM region
UNION ALL
SELECT r_regionkey, CAST(2 AS BIGINT), 'PROCESS_NAME' FROM region
UNION ALL
SELECT n_regionkey, CAST(2 + row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS BIGINT), n_name
FROM nation JOIN region ON n_regionkey = r_regionkey {where}
"""


def _merged(col: str) -> str:
    clean = f"regexp_replace({col}, '^\\s+|\\s+$', '', 'g')"
    return (f"coalesce(string_agg(DISTINCT {clean}, ' ' ORDER BY {clean}) "
            f"FILTER (WHERE {col} IS NOT NULL AND {clean} <> ''), '') AS {col.split('(')[-1]}")


_DOC = "'doc_' || CAST(doc_id AS VARCHAR) || '.txt'"
_NORM = ("list_filter(list_transform(string_split(text, chr(10)), "
         "lambda l: regexp_replace(l, '[ \\t\\n\\x0B\\f\\r]', '', 'g')), lambda l: l <> '')")

ORACLE_SQL: dict[str, str] = {
    "daily_etl": ETL_SELECT + f"  AND CAST(l.l_shipdate AS DATE) = {MAX_SHIP}",
    "daily_backfill": ETL_SELECT + f"  AND CAST(l.l_shipdate AS DATE) BETWEEN {MAX_SHIP} - 29 AND {MAX_SHIP}",
    "latest_date": "SELECT coalesce(max(CAST(o_orderdate AS DATE)), DATE '2024-01-01') AS latest_date FROM orders",
    "pending_days": """
SELECT m - 9 + CAST(i AS INTEGER) AS day
FROM (SELECT max(CAST(ts AS DATE)) AS m FROM events) s, range(1, 10) t(i)
""",
    "overwrite_partition": _ORDERS_BY_MONTH + """
SELECT o.* FROM o, m WHERE o.o_month <> m.mm
UNION ALL
SELECT o.* FROM o, m WHERE o.o_month = m.mm AND o.o_orderstatus = 'O'
""",
    "latest_partition": "SELECT max('o_month=' || strftime(o_orderdate, '%Y-%m')) AS latest_partition FROM orders",
    "upsert_replace": "WITH " + _CUSTOMERS + """,
d AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100.0 AS c_acctbal, c_mktsegment FROM changed)
SELECT * FROM d
UNION ALL
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.c_custkey = t.c_custkey)
""",
    "upsert_coalesce": "WITH " + _CUSTOMERS + """,
d AS (SELECT c_custkey, c_name || '*' AS c_name,
             CASE WHEN c_acctbal >= 0 THEN c_acctbal + 100.0 END AS c_acctbal FROM changed)
SELECT coalesce(d.c_custkey, t.c_custkey) AS c_custkey, coalesce(d.c_name, t.c_name) AS c_name,
       t.c_nationkey, coalesce(d.c_acctbal, t.c_acctbal) AS c_acctbal, t.c_mktsegment
FROM t FULL OUTER JOIN d ON t.c_custkey = d.c_custkey
""",
    "upsert_update": "WITH " + _CUSTOMERS + """,
d0 AS (SELECT o_custkey AS c_custkey, o_totalprice AS c_acctbal,
              CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS c_mktsegment,
              row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
       FROM orders),
d AS (SELECT * FROM d0 WHERE rn = 1)
SELECT coalesce(d.c_custkey, t.c_custkey) AS c_custkey, t.c_name, t.c_nationkey,
       CASE WHEN d.rn IS NOT NULL THEN d.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN d.rn IS NOT NULL THEN d.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM t FULL OUTER JOIN d ON t.c_custkey = d.c_custkey
""",
    "merge_rows": """
SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, {s}, {p}, {y}
FROM (SELECT o_custkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y') AS o_year FROM orders)
WHERE o_custkey IS NOT NULL AND CAST(o_custkey AS VARCHAR) <> ''
GROUP BY o_custkey
""".format(s=_merged("o_orderstatus"), p=_merged("o_orderpriority"), y=_merged("o_year")),
    "page": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100",
    "assign_chunks": """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_index, count(*) OVER () AS n
           FROM orders)
SELECT o_orderkey, row_index, CAST(floor((row_index - 1) / ceil(n / 7.0)) + 1 AS INTEGER) AS chunk_id FROM r
""",
    "export_chunks": _CHUNKS.format(n=7),
    "export_resume": """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders),
     c AS (SELECT o_orderkey, CAST(floor((rn - 1) / ceil(n / 5.0)) + 1 AS INTEGER) AS chunk FROM r)
SELECT 'part_' || CAST(chunk AS VARCHAR) || '.csv' AS file_name, CASE WHEN chunk IN (1, 3) THEN 'first' ELSE 'second' END AS run,
       count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM c GROUP BY chunk
""",
    "batch_ranges": """
WITH r AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS pos,
                  ntile(9) OVER (ORDER BY p_partkey) AS batch FROM part)
SELECT CAST(batch AS INTEGER) AS batch, min(pos) AS start_pos, max(pos) AS end_pos, count(*) AS rows,
       min(p_partkey) AS min_key, max(p_partkey) AS max_key
FROM r GROUP BY batch
""",
    "row_id": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS row_id FROM documents",
    "csv_text_roundtrip": """
SELECT coalesce(CAST(s_suppkey AS VARCHAR), '') AS s_suppkey, coalesce(s_name, '') AS s_name,
       coalesce(CAST(s_nationkey AS VARCHAR), '') AS s_nationkey,
       coalesce(CAST(s_acctbal AS VARCHAR), '') AS s_acctbal
FROM supplier
""",
    "csv_typed_load": "SELECT n_nationkey AS n_nationkey, n_name AS n_name, n_regionkey AS n_regionkey FROM nation",
    "csv_ragged_rows": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE c_name END AS c_name,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS is_corrupt
FROM customer
""",
    "overwrite_table": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1.0 AS c_acctbal, c_mktsegment FROM customer
""",
    "copy_day": """
SELECT *, CAST(ts AS DATE) AS ingest_date FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""",
    "ddl_table": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "create_like": "SELECT * FROM customer",
    "load_overwrite": "SELECT * FROM nation WHERE n_regionkey = 1",
    "infer_ddl": """
SELECT * FROM (VALUES (1, 'o_orderkey', 'BIGINT'), (2, 'o_custkey', 'BIGINT'), (3, 'o_orderstatus', 'STRING'),
                      (4, 'o_totalprice', 'DOUBLE'), (5, 'o_orderdate', 'STRING'),
                      (6, 'o_orderpriority', 'STRING'), (7, 'is_final', 'BOOLEAN'))
       AS t(ordinal, column_name, data_type)
""",
    "split_rejects": """
SELECT event_id,
       CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE value END AS value,
       CASE WHEN event_type = 'error' OR (event_type = 'click' AND value IS NOT NULL) THEN 'value' END
           AS _reject_reason
FROM events
""",
    "external_table": "SELECT p_partkey, p_name, p_type, p_size, p_retailprice, p_brand FROM part",
    "verify_table": """
SELECT count(*) AS row_count, 11 AS n_columns,
       'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,'
       || 'l_returnflag,l_linestatus,l_shipdate' AS column_list
FROM lineitem
""",
    "conform": """
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_phone, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal
FROM customer
""",
    "parse_pipe_records": pipe_sql(["PROCESS_NAME", "DSSTATUS", "DSDAY", "DSPRICE", "DSLINK", "DSREF"]),
    "xml_layout": _layout_sql(None),
    "xml_layout_exclude": _layout_sql("NATION_0"),
    "load_by_layout": pipe_sql(["PROCESS_NAME", "DSSTATUS", "DSDAY", "DSLINK", "DSREF"]),
    "presence_matrix": f"""
WITH a AS (SELECT DISTINCT {_DOC} AS f FROM documents WHERE lang IN ('en', 'de')),
     b AS (SELECT DISTINCT {_DOC} AS f FROM documents WHERE lang IN ('de', 'fr', 'es') AND source <> 'src0')
SELECT coalesce(a.f, b.f) AS file_name,
       CASE WHEN a.f IS NOT NULL THEN 'Y' ELSE 'N' END AS in_folder1,
       CASE WHEN b.f IS NOT NULL THEN 'Y' ELSE 'N' END AS in_folder2
FROM a FULL OUTER JOIN b ON a.f = b.f
""",
    "compare_datasets": f"""
WITH a AS (SELECT {_DOC} AS f, text FROM documents),
     b AS (SELECT {_DOC} AS f,
                  CASE lang WHEN 'en' THEN replace(text, ' ', '  ') || chr(10) || chr(10)
                            WHEN 'de' THEN text || ' extra'
                            ELSE replace(text, chr(10), chr(10) || ' ' || chr(9) || chr(10)) END AS text
           FROM documents WHERE lang <> 'fr'
           UNION ALL
           SELECT 'bench_' || CAST(item_id AS VARCHAR) || '.txt', text FROM benchmark),
     na AS (SELECT f, {_NORM} AS n FROM a),
     nb AS (SELECT f, {_NORM} AS n FROM b)
SELECT coalesce(na.f, nb.f) AS file_name,
       CASE WHEN na.f IS NOT NULL THEN 'Y' ELSE 'N' END AS in_folder1,
       CASE WHEN nb.f IS NOT NULL THEN 'Y' ELSE 'N' END AS in_folder2,
       CASE WHEN na.f IS NOT NULL AND nb.f IS NOT NULL
            THEN CASE WHEN na.n = nb.n THEN 'Y' ELSE 'N' END ELSE 'N/A' END AS content_match
FROM na FULL OUTER JOIN nb ON na.f = nb.f
""",
    "count_files": """
SELECT 'csv' AS ext, count(*) AS files FROM (SELECT DISTINCT p_brand FROM part)
UNION ALL SELECT 'parquet', count(*) FROM (SELECT DISTINCT p_type FROM part)
UNION ALL SELECT 'json', count(*) FROM (SELECT DISTINCT p_size FROM part)
""",
    "pending_files": """
SELECT l.page_id, l.url AS path FROM pages l
WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.url LIKE '%/en/%' AND p.url = l.url)
""",
    "run_sql_steps": """
WITH recent_orders AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
  WHERE o_orderdate >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - INTERVAL 365 DAY)
SELECT c.c_mktsegment, r.o_orderpriority, count(*) AS n_orders, max(r.o_totalprice) AS max_price
FROM recent_orders r JOIN customer c ON r.o_custkey = c.c_custkey
GROUP BY c.c_mktsegment, r.o_orderpriority
""",
    "ingest_stream": """
SELECT event_id, ts, user_id, event_type, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""",
    "scalar_formats": """
SELECT o_orderkey,
       regexp_extract(o_orderpriority, '^(\\d+)-', 1) AS priority_code,
       regexp_replace(o_orderpriority, '^\\d+-', '') AS priority_label,
       starts_with(upper(o_orderpriority), '1-') AS is_urgent,
       translate(o_orderpriority, ' -.', '___') AS clean_label,
       trim('  ' || o_orderstatus || ' ') AS status_trim,
       o_orderstatus || '-' || CAST(o_custkey AS VARCHAR) AS value_extra,
       strftime(o_orderdate, '%Y-%m-%d') AS order_day,
       strftime(o_orderdate, '%Y%m%d') AS order_day_compact,
       CAST(o_orderdate AS DATE) + 1 AS next_day,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' +00:00' AS stamp_utc,
       printf('%02d', month(o_orderdate)) AS month_serial,
       printf('%02d', o_orderkey % 1000) AS key_serial,
       CAST(ceil(o_totalprice / 1000) AS BIGINT) AS price_bucket,
       o_orderkey // 7 AS key_div,
       o_orderkey % 7 AS key_mod,
       CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
       CAST(o_orderkey AS VARCHAR) || '.csv.updated' AS marked_name,
       '/data/sales/' || strftime(o_orderdate, '%Y/%m/%d') AS day_path,
       coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS priority_or_none
FROM orders
""",
}
