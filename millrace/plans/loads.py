"""CSV file to typed catalog table in one call: read with type inference,
clean the column names, create the database and table from the inferred DDL
(under a type policy), load the rows by position, and report.

Rows whose text does not convert to the inferred types are written to a
reject table instead of failing the load (typed loads happen with
``try_cast``; a bad cell never aborts the job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lattice, schema
from ..session import written
from ..sources import files, tables
from ..sources.csvsplit import read_csv_by_header


def load_csv_to_table(spark: SparkSession, path: str, table: str, *, policy: str = "int32",
                      database: str | None = None, database_location: str | None = None,
                      location: str | None = None, fmt: str = "parquet", sep: str = ",",
                      header: bool = True, replace: bool = True,
                      reject_table: str | None = None) -> DataFrame:
    """Load a CSV into a new table and return the one-row verify report
    (``row_count, n_columns, column_list``) of the loaded table."""
    typed = schema.clean_names(files.read_csv_typed(spark, path, sep=sep, header=header))
    columns = schema.ddl_columns(typed, policy)
    name = tables.create_table(spark, table, columns, replace=replace, database=database,
                               database_location=database_location, fmt=fmt, location=location)
    if reject_table is None:
        tables.load_table(typed, name, "append")
    else:
        # re-read as text and cast under the policy, so bad cells become rejects
        text = schema.clean_names(files.read_csv_text(spark, path, sep=sep, header=header,
                                                      empty_as_text=False))
        good, bad = schema.split_rejects(text, dict(columns))
        tables.load_table(good, name, "append")
        bad.write.mode("append").saveAsTable(reject_table)
    return tables.verify_table(spark.table(name))


def load_csv_by_lattice(spark: SparkSession, path: str, table: str, reject_table: str, *, policy: str = "int32", tolerance: float = 0.0,
                        location: str | None = None, sep: str = ",") -> DataFrame:
    """:func:`load_csv_to_table` for CSV of any size: files are read by many tasks, each by its own
    header, and written once as text; types come from all cells of that (see
    :mod:`millrace.operators.lattice`), so no row is sampled. Rows that do not fit their header,
    and with a ``tolerance`` rows with a cell that does not fit its column, go to
    ``reject_table`` (``reason, record``). Returns the verify report."""
    rows, broken = read_csv_by_header(spark, path, sep=sep)
    text = written(schema.clean_names(rows), "csv-text")
    types = dict(lattice.ddl_types(lattice.column_types(text), policy, tolerance))
    good, bad = schema.split_rejects(text, types)
    # an empty cell is a value of a text column and none of any other
    name = tables.create_table(spark, table, list(types.items()), replace=True, location=location)
    tables.load_table(good, name, "append")
    bad = bad.select(F.col(schema.REASON).alias("reason"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in text.columns])).alias("record"))
    broken.select("reason", "record").unionByName(bad).write.mode("append").saveAsTable(reject_table)
    return tables.verify_table(spark.table(name))
