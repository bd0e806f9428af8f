"""Command line for the script-style flows: ``python -m millrace <command> ...``.

Each command is one Spark job over the given paths; results are written as
files (CSV with a header) or printed when small (reports, counts).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from .session import get_session


def _spark(args):
    conf = {}
    if args.checkpoint_dir:
        conf["spark.checkpoint.dir"] = args.checkpoint_dir
    return get_session(args.master, "millrace-cli", **conf)


def _read(spark, path: str, fmt: str):
    if fmt == "csv":
        from .sources.files import read_csv_text
        return read_csv_text(spark, path)
    if fmt == "table":
        return spark.table(path)
    return spark.read.format(fmt).load(path)


def _print(df, most: int = 1000) -> None:
    """Print a result; of a longer one the first rows, and say how many there are."""
    df.show(most, truncate=False)
    n = df.count()
    if n > most:
        print(f"{most} of {n} rows are shown; --output writes all of them")


def cmd_export(args) -> None:
    from .sources.export import export_chunks
    spark = _spark(args)
    df = _read(spark, args.source, args.format)
    run_date = args.run_date or _dt.date.today().isoformat()
    manifest = export_chunks(df, args.chunks, args.out, args.order_by, run_date, resume=args.resume,
                             naming=args.naming, default_if_nonpositive=args.default_chunks)
    planned = args.chunks if args.chunks > 0 else args.default_chunks
    manifest.orderBy("file_name").show(planned, truncate=False)


def cmd_merge_rows(args) -> None:
    from .operators.merge import merge_rows
    from .sources.files import read_csv_text, write_csv
    spark = _spark(args)
    write_csv(merge_rows(read_csv_text(spark, args.input), args.key), args.output)


def cmd_run_sql(args) -> None:
    from .plans.sqlsteps import run_sql_steps
    from .sources.files import write_csv
    spark = _spark(args)
    params = dict(p.split("=", 1) for p in args.param)
    with open(args.script, encoding="utf-8") as f:
        result = run_sql_steps(spark, f.read(), args=params, style=args.style)
    if result is not None and args.output:
        write_csv(result, args.output)
    elif result is not None:
        _print(result)


def cmd_compare(args) -> None:
    from .operators.compare import compare_folders
    from .sources.files import write_csv
    spark = _spark(args)
    report = compare_folders(spark, args.folder1, args.folder2, by_line=args.by_line)
    if args.output:
        write_csv(report.orderBy("file_name"), args.output)
    else:
        _print(report.orderBy("file_name"))


def cmd_count_files(args) -> None:
    from .sources.files import count_files
    spark = _spark(args)
    found = count_files(spark, args.directory, args.ext).orderBy("ext")
    for row in found.toLocalIterator():  # one line per extension, all of them
        print(f"{row['ext']}\t{row['files']}")


def cmd_load_csv(args) -> None:
    from .plans.loads import load_csv_to_table
    spark = _spark(args)
    report = load_csv_to_table(spark, args.path, args.table, policy=args.policy, database=args.database,
                               location=args.location, sep=args.sep, reject_table=args.reject_table)
    report.show(truncate=False)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m millrace")
    p.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    p.add_argument("--checkpoint-dir", default=None, help="shared folder, if the cluster sets none")
    sub = p.add_subparsers(dest="command", required=True)

    e = sub.add_parser("export", help="export a table into N evenly sized CSV chunks")
    e.add_argument("--source", required=True)
    e.add_argument("--format", default="parquet", help="parquet | csv | orc | table")
    e.add_argument("--out", required=True)
    e.add_argument("--chunks", type=int, default=15)
    e.add_argument("--default-chunks", type=int, default=None, help="used when --chunks <= 0")
    e.add_argument("--order-by", required=True)
    e.add_argument("--run-date", default=None)
    e.add_argument("--naming", default="dated", choices=["dated", "part"])
    e.add_argument("--resume", action="store_true")
    e.set_defaults(func=cmd_export)

    m = sub.add_parser("merge-rows", help="consolidate CSV rows by key")
    m.add_argument("--input", required=True)
    m.add_argument("--output", required=True)
    m.add_argument("--key", default="id")
    m.set_defaults(func=cmd_merge_rows)

    r = sub.add_parser("run-sql", help="run a labelled SQL step script")
    r.add_argument("--script", required=True)
    r.add_argument("--style", default="blocks", choices=["blocks", "statements"])
    r.add_argument("--param", action="append", default=[], help="name=value, repeatable")
    r.add_argument("--output", default=None)
    r.set_defaults(func=cmd_run_sql)

    c = sub.add_parser("compare", help="compare two folders of text files")
    c.add_argument("--folder1", required=True)
    c.add_argument("--folder2", required=True)
    c.add_argument("--by-line", action="store_true", help="for files too large to be one row")
    c.add_argument("--output", default=None)
    c.set_defaults(func=cmd_compare)

    n = sub.add_parser("count-files", help="count files by extension, recursively")
    n.add_argument("directory")
    n.add_argument("ext", nargs="?", default=None)
    n.set_defaults(func=cmd_count_files)

    lo = sub.add_parser("load-csv", help="CSV to typed table with inferred DDL")
    lo.add_argument("--path", required=True)
    lo.add_argument("--table", required=True)
    lo.add_argument("--policy", default="int32", choices=["int32", "int64", "int64_ts"])
    lo.add_argument("--database", default=None)
    lo.add_argument("--location", default=None)
    lo.add_argument("--sep", default=",")
    lo.add_argument("--reject-table", default=None)
    lo.set_defaults(func=cmd_load_csv)
    return p


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    args.func(args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
