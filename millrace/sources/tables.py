"""Catalog tables: DDL building, create/drop, loads, partition overwrite,
self-overwrite through a staging location, partition listing and verification.

Everything goes through the session catalog with datasource tables (parquet,
ORC, CSV); a delimiter becomes the CSV ``sep`` option, which works with or
without Hive support.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, unique_name

_VARCHAR = re.compile(r"^\s*(VAR)?CHAR\s*\(\s*\d+\s*\)\s*$", re.IGNORECASE)


def quote(name: str) -> str:
    """Back-quote each part of a (possibly qualified) identifier."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def schema_type(type_text: str) -> str:
    """Type for DataFrame schemas: ``VARCHAR(n)``/``CHAR(n)`` become STRING."""
    return "STRING" if _VARCHAR.match(type_text) else type_text.strip()


def schema_ddl(columns: Sequence[tuple[str, str]]) -> str:
    """``name TYPE, ...`` string usable as a DataFrame schema."""
    return ", ".join(f"{quote(n)} {schema_type(t)}" for n, t in columns)


def build_ddl(table: str, columns: Sequence[tuple[str, str]], *, if_not_exists: bool = True,
              fmt: str = "parquet", delimiter: str | None = None, location: str | None = None,
              partition_by: Sequence[tuple[str, str]] = (), comment: str | None = None,
              options: Mapping[str, str] | None = None) -> str:
    """``CREATE TABLE`` text from a (name, type) list.

    Partition columns are declared with the data columns (datasource syntax)
    and listed in ``PARTITIONED BY``; a delimiter maps to the CSV ``sep``."""
    cols = list(columns) + list(partition_by)
    parts = [f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{quote(table)} (",
             ",\n".join(f"  {quote(n)} {t}" for n, t in cols), f") USING {fmt}"]
    opts = dict(options or {})
    if delimiter is not None:
        opts["sep"] = delimiter
    if opts:
        parts.append("OPTIONS (" + ", ".join(f"{_sql_text(k)} = {_sql_text(v)}" for k, v in opts.items()) + ")")
    if partition_by:
        parts.append("PARTITIONED BY (" + ", ".join(quote(n) for n, _ in partition_by) + ")")
    if location:
        parts.append(f"LOCATION {_sql_text(location)}")
    if comment:
        parts.append(f"COMMENT {_sql_text(comment)}")
    return "\n".join(parts)


def create_table(spark: SparkSession, table: str, columns: Sequence[tuple[str, str]], *,
                 replace: bool = False, database: str | None = None,
                 database_location: str | None = None, **ddl_args) -> str:
    """Create the database if missing, optionally drop the table, create it.
    Returns the qualified table name."""
    if database:
        loc = f" LOCATION {_sql_text(database_location)}" if database_location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(database)}{loc}")
        table = f"{database}.{table}"
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {quote(table)}")
    spark.sql(build_ddl(table, columns, **ddl_args))
    return table


def create_like(spark: SparkSession, table: str, source: str, *, location: str | None = None,
                fmt: str = "parquet") -> None:
    """Empty table with the structure of ``source``."""
    loc = f" LOCATION {_sql_text(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quote(table)} LIKE {quote(source)} USING {fmt}{loc}")


def register_external(spark: SparkSession, table: str, path: str, *, fmt: str = "parquet",
                      columns: Sequence[tuple[str, str]] | None = None,
                      partition_by: Sequence[tuple[str, str]] = (),
                      options: Mapping[str, str] | None = None) -> DataFrame:
    """Table over files already written at ``path``; partitions are recovered.

    Without ``columns`` the schema is read from the files."""
    if columns is None:
        opts = ""
        if options:
            opts = " OPTIONS (" + ", ".join(f"{_sql_text(k)} = {_sql_text(v)}" for k, v in options.items()) + ")"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {quote(table)} USING {fmt}{opts} LOCATION {_sql_text(path)}")
    else:
        spark.sql(build_ddl(table, columns, fmt=fmt, location=path, partition_by=partition_by,
                            options=options))
    if _is_partitioned(spark, table):
        recover_partitions(spark, table)
    return spark.table(table)


def _is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Register partition folders added outside the catalog (``MSCK REPAIR``)."""
    spark.catalog.recoverPartitions(table)


def load_table(df: DataFrame, table: str, mode: str = "append") -> None:
    """Load rows into an existing table, columns matched by position.

    ``mode`` is ``append`` or ``overwrite`` (whole table, or for a partitioned
    table the partitions present in ``df`` under dynamic overwrite)."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    df.write.insertInto(table, overwrite=(mode == "overwrite"))


def overwrite_partition(spark: SparkSession, df: DataFrame, table: str,
                        spec: Mapping[str, object] | None = None) -> None:
    """Replace partitions of a catalog table.

    With ``spec`` (static values, e.g. ``{"sale_date": "2024-01-01"}``) exactly
    that partition is replaced and ``df`` carries only the data columns; without
    it the partitions present in ``df`` are replaced (dynamic mode)."""
    if spec:
        view = unique_name("__overwrite")
        df.createOrReplaceTempView(view)
        part = ", ".join(f"{quote(k)} = :p{i}" for i, k in enumerate(spec))
        args = {f"p{i}": v for i, v in enumerate(spec.values())}
        cols = ", ".join(quote(c) for c in df.columns)
        try:
            spark.sql(f"INSERT OVERWRITE TABLE {quote(table)} PARTITION ({part}) SELECT {cols} FROM {view}",
                      args=args)
        finally:
            spark.catalog.dropTempView(view)
    else:
        with _session_conf(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            df.write.insertInto(table, overwrite=True)


class _session_conf:
    def __init__(self, spark: SparkSession, key: str, value: str):
        self.spark, self.key, self.value = spark, key, value

    def __enter__(self):
        self.old = self.spark.conf.get(self.key, None)
        self.spark.conf.set(self.key, self.value)

    def __exit__(self, *exc):
        if self.old is None:
            self.spark.conf.unset(self.key)
        else:
            self.spark.conf.set(self.key, self.old)


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """Provider, Location and the like of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote(table)}").where("col_name in ('Provider', 'Location')").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def overwrite_table(spark: SparkSession, df: DataFrame, table: str, *, fmt: str = "parquet",
                    location: str | None = None) -> str:
    """Replace a whole table with ``df``, even when ``df`` reads that table.

    Spark refuses to overwrite a path it is reading, so the rows go to a fresh
    location first (by default beside the old one) and the table is then pointed
    at it (a metadata swap); the old files stay until the caller removes them. A
    table that is neither Parquet nor ORC keeps its place: the rows are staged in
    the shared folder and inserted, so its own format and options hold. ``fmt`` is
    the format of a table that does not exist yet. Returns the table's location."""
    info = _described(spark, table) if spark.catalog.tableExists(table) else None
    if info is not None:
        fmt = info["Provider"].lower()
        if fmt not in ("parquet", "orc"):
            if location is not None:
                raise ValueError(f"a {fmt} table keeps its location")
            staged = scratch_path(spark, f"table-{table.replace('.', '_')}")
            df.write.parquet(staged)
            rows = spark.read.schema(df.schema).parquet(staged).select(*spark.table(table).columns)
            with _session_conf(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
                rows.write.insertInto(table, overwrite=True)
            return info["Location"]
        old = info["Location"].rstrip("/").split("__swap_")[0]
        new_location = location or unique_name(f"{old}__swap")
    else:
        new_location = location or scratch_path(spark, f"table-{table.replace('.', '_')}")
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition] if info else []
    writer = df.write.mode("overwrite").format(fmt)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(new_location)
    if info is None:
        spark.sql(f"CREATE TABLE {quote(table)} USING {fmt} LOCATION {_sql_text(new_location)}")
    else:
        spark.sql(f"ALTER TABLE {quote(table)} SET LOCATION {_sql_text(new_location)}")
        if parts:
            recover_partitions(spark, table)
        spark.catalog.refreshTable(table)
    return new_location


def latest_partition(spark: SparkSession, table: str, alias: str = "latest_partition") -> DataFrame:
    """One row: the greatest partition spec as text (``k=v``), null if none.

    Text order, as ``SHOW PARTITIONS`` sorted: fine for ``yyyy-MM-dd`` values."""
    parts = spark.sql(f"SHOW PARTITIONS {quote(table)}")
    return parts.agg(F.max("partition").alias(alias))


def verify_table(df: DataFrame) -> DataFrame:
    """One-row load report: row count, column count and column list."""
    cols = df.columns
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(cols)).alias("n_columns"), F.lit(",".join(cols)).alias("column_list"))


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows, unordered (the post-load eyeball check)."""
    return df.limit(n)
