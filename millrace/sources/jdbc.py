"""Relational sources and sinks over Spark's JDBC data source.

Reads are partitioned on a numeric/date column (``partitionColumn`` with
bounds), so every executor reads one slice; the page-by-page ``LIMIT/OFFSET``
loop of a single client becomes one parallel scan. Writes are batched by the
driver's ``batchsize``.

Upserts into a database table: Spark's JDBC writer only appends or replaces,
so the delta is reduced to one row per key (last wins, as the rows would
apply in order), appended to a staging table, and merged by one statement
the database runs (``INSERT ... ON CONFLICT ... DO UPDATE`` for PostgreSQL,
``INSERT ... ON DUPLICATE KEY UPDATE`` for MySQL) -- all or nothing.

No database runs in this repository's tests, so this module is exercised
only up to building options and statements.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.merge import latest_by_key

# fixed values: JDBC driver classes and URL prefixes per database kind
DRIVERS = {
    "postgresql": ("org.postgresql.Driver", "jdbc:postgresql://{host}:{port}/{database}"),
    "mysql": ("com.mysql.cj.jdbc.Driver", "jdbc:mysql://{host}:{port}/{database}"),
}


def jdbc_options(kind: str, *, host: str, port: int, database: str, user: str, password: str,
                 **extra: str) -> dict[str, str]:
    """Connection options for a database kind; an unknown kind is an error."""
    if kind not in DRIVERS:
        raise ValueError(f"unsupported database type {kind!r}; use one of {sorted(DRIVERS)}")
    driver, url = DRIVERS[kind]
    opts = {"driver": driver, "url": url.format(host=host, port=port, database=database),
            "user": user, "password": password}
    opts.update(extra)
    return opts


def read_jdbc(spark: SparkSession, options: Mapping[str, str], *, table: str | None = None,
              query: str | None = None, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """A table or a query as a DataFrame, read in parallel slices of
    ``partition_column`` when it is given (table reads only)."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", fetch_size)
    if query is not None:
        reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table)
        if partition_column is not None:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                      .option("numPartitions", num_partitions or 8))
    return reader.load()


def write_jdbc(df: DataFrame, options: Mapping[str, str], table: str, *, mode: str = "append",
               batch_size: int = 1000) -> None:
    """Append (or overwrite) rows into a database table in batches."""
    df.write.format("jdbc").options(**options).option("dbtable", table) \
        .option("batchsize", batch_size).mode(mode).save()


def _q(name: str, kind: str) -> str:
    return f"`{name}`" if kind == "mysql" else f'"{name}"'


def upsert_statement(kind: str, target: str, staging: str, columns: Sequence[str],
                     keys: Sequence[str]) -> str:
    """The single merge statement from staging into target: insert new keys,
    update the delta's columns of existing ones."""
    cols = ", ".join(_q(c, kind) for c in columns)
    updates = [c for c in columns if c not in keys]
    if kind == "postgresql":
        conflict = ", ".join(_q(k, kind) for k in keys)
        sets = ", ".join(f"{_q(c, kind)} = EXCLUDED.{_q(c, kind)}" for c in updates)
        action = f"DO UPDATE SET {sets}" if sets else "DO NOTHING"
        return (f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {staging} "
                f"ON CONFLICT ({conflict}) {action}")
    if kind == "mysql":
        sets = ", ".join(f"{_q(c, kind)} = VALUES({_q(c, kind)})" for c in updates) or \
            f"{_q(keys[0], kind)} = {_q(keys[0], kind)}"
        return f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {staging} ON DUPLICATE KEY UPDATE {sets}"
    raise ValueError(f"unsupported database type {kind!r}")


def stage_upsert(delta: DataFrame, options: Mapping[str, str], kind: str, target: str, staging: str,
                 keys: Sequence[str], order_by: Sequence[str] | None = None) -> str:
    """Write the delta (last row per key when ``order_by`` is given) to the
    staging table and return the statement that merges it into ``target``;
    the database runs that one statement as a single transaction."""
    if order_by:
        delta = latest_by_key(delta, list(keys), list(order_by)).drop(*order_by)
    write_jdbc(delta, options, staging, mode="overwrite")
    return upsert_statement(kind, target, staging, delta.columns, list(keys))
