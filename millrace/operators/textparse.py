"""Semi-structured text: pipe key/value records to wide rows, XML layouts to
column lists, and the two composed.

The pipe record walk is position dependent (a key decides how many tokens it
consumes). It is a left-to-right tokenisation, so it is one native regular
expression applied with ``regexp_extract_all`` (a ``\\G``-anchored step
pattern); each target column is then found with ``array_position`` on the
step keys. Everything stays in generated code: no Python UDF, no lambda.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import written
from .chunks import running_before, with_row_index, with_split_order_index

# fixed values of the record format
ID_KEY = "ID"
NAME_KEY = "PROCESS_NAME"
VALUE_KEY_PREFIX = "DS"
FIXED_COLUMNS = (ID_KEY, NAME_KEY)

_LAYOUT_SCHEMA = "field array<struct<name:array<string>>>, _corrupt_record string"


# One walk step as a regular expression, matched repeatedly from the left with
# \G (each match starts where the previous one ended): the key ID with its
# value, PROCESS_NAME with its value, a DS* key with up to two more tokens, or
# any other single token. The line gets a leading '|' so every step is a
# non-empty match starting at a separator.
_STEP_BODY = (ID_KEY + r"(?=\||\z)(?:\|[^|]*)?"
              r"|" + NAME_KEY + r"(?=\||\z)(?:\|[^|]*)?"
              r"|" + VALUE_KEY_PREFIX + r"[^|]*(?:\|[^|]*){0,2}"
              r"|[^|]*")
_STEP = r"\G\|(" + _STEP_BODY + ")"
# the same steps, capturing only the key token of a step that has a value (a
# lookahead reads it without consuming; a key with no value assigns nothing,
# so it must not hide an earlier value): aligned with the steps by construction
_STEP_KEY = r"\G\|(?:(?=([^|]*)\|))?(?:" + _STEP_BODY + ")"


def pipe_steps(line: Column) -> Column:
    """``array<string>`` of the walk's steps, each ``key[|token[|token]]``.

    Walk, left to right: ``ID`` skips itself and its value; ``PROCESS_NAME``
    takes the next token; a ``DS*`` key takes the next two tokens (fewer at the
    end of the line); any other token is one step on its own. The walk is a
    tokenisation, so one regular expression does it.
    """
    return F.regexp_extract_all(F.concat(F.lit("|"), line), F.lit(_STEP), 1)


def step_keys(line: Column) -> Column:
    """The key (first token) of every step of ``line`` that carries a value
    (null for the others), aligned with :func:`pipe_steps`."""
    return F.regexp_extract_all(F.concat(F.lit("|"), line), F.lit(_STEP_KEY), 1)


def step_value(steps: Column, rev_keys: Column, key: str) -> Column:
    """Value of the last step with a value whose key is ``key`` (a repeated
    key keeps the last value): ``value-extra``, the value alone, or null when
    the key never has a value. ``rev_keys`` is ``reverse(step_keys(line))``."""
    from_end = F.array_position(rev_keys, F.lit(key))
    step = F.when(from_end > 0, F.element_at(steps, (F.size(steps) - from_end + 1).cast("int")))
    # the step is "key", "key|value" or "key|value|extra"; the key length is known
    rest = F.substring(step, len(key) + 2, 1 << 30)
    return F.when(F.length(step) > len(key), F.translate(rest, "|", "-"))


def parse_pipe_records(lines: DataFrame, line_col: str, target_columns: Sequence[str], *,
                       order_by=None, id_col: str = ID_KEY, numbered: bool = False) -> DataFrame:
    """Pipe records to a wide frame with exactly ``target_columns`` (text),
    missing keys as null, keys outside the list dropped. ``id_col`` (when it is
    a target) is a fresh 1..N number in ``order_by`` order, replacing the
    record's own ID. ``numbered=True`` means ``lines`` already carries the
    number in ``__id``."""
    if id_col in target_columns and not numbered:
        if order_by is None:
            raise ValueError("order_by is required to number the records")
        if isinstance(order_by, str) and order_by == FILE_ORDER:
            lines = with_split_order_index(lines, ["__file", "__block"], "__pos", "__id")
        else:
            lines = with_row_index(lines, order_by, "__id").drop("__total")
    # parsed after numbering: the walk runs once per line, on the numbered rows
    keep = ["__id"] if id_col in target_columns else []
    walked = lines.select(*keep, pipe_steps(F.col(line_col)).alias("__steps"),
                          F.reverse(step_keys(F.col(line_col))).alias("__rkeys"))
    cols = []
    for name in target_columns:
        if name == id_col:
            cols.append(F.col("__id").alias(name))
        else:
            cols.append(step_value(F.col("__steps"), F.col("__rkeys"), name).alias(name))
    return walked.select(*cols)


FILE_ORDER = "file order"  # order_by value: number lines as read by read_lines


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their file order: ``line, __file, __block, __pos``.

    ``(__file, __block, __pos)`` sorts lines in file order: splits of a file are
    read front to back and positions grow inside a task."""
    raw = spark.read.text(path)
    return raw.select(F.col("value").alias("line"),
                      F.col("_metadata.file_path").alias("__file"),
                      F.col("_metadata.file_block_start").alias("__block"),
                      F.monotonically_increasing_id().alias("__pos"))


def number_stripped_lines(lines: DataFrame, index_col: str = "__id", *, line_col: str = "line") -> DataFrame:
    """Number the lines of :func:`read_lines` 1..N in file order after applying
    ``text.strip()`` to every file: blank lines before the first and after the
    last non-blank line are dropped, the first kept line loses its leading
    white space and the last its trailing white space (a file with no text
    keeps one empty line, as ``''.split('\\n')`` does).

    One aggregation over ``(file, split)`` yields everything: per split its
    row count, first position and first/last non-blank position; the offsets
    and per-file edges are then computed on that table (one row per split, written
    once, summed in two levels) and broadcast back if small. The lines themselves
    are never shuffled."""
    from ..functions.text import PY_SPACE
    from ..plans.joins import broadcast_if_small

    split = ["__file", "__block"]
    text = F.btrim(F.col(line_col), F.lit(PY_SPACE)) != ""
    pos = F.col("__pos")
    per_split = written(lines.groupBy(*split).agg(
        F.count(F.lit(1)).alias("__n"), F.min(pos).alias("__p0"),
        F.min(F.when(text, pos)).alias("__t0"), F.max(F.when(text, pos)).alias("__t1")), "splits")
    per_split = running_before(per_split, split, "__n", "__off")

    def glob(p: Column) -> Column:  # global 1-based index of a position of this split
        return p - F.col("__p0") + F.col("__off") + 1

    file_w = Window.partitionBy("__file")
    per_split = per_split.select(
        *split, "__p0", "__off",
        F.coalesce(F.min(glob(F.col("__t0"))).over(file_w),
                   F.min(glob(F.col("__p0"))).over(file_w)).alias("__keep_from"),
        F.coalesce(F.max(glob(F.col("__t1"))).over(file_w),
                   F.min(glob(F.col("__p0"))).over(file_w)).alias("__keep_to"))
    per_split = written(per_split, "split-edges")
    per_file = per_split.select("__file", (F.col("__keep_to") - F.col("__keep_from") + 1).alias("__kept")).distinct()
    per_file = running_before(written(per_file, "files"), "__file", "__kept", "__kept_before").drop("__kept")
    info = written(per_split.join(per_file, "__file"), "split-offsets")
    joined = lines.join(broadcast_if_small(info), split)
    idx = pos - F.col("__p0") + F.col("__off") + 1
    kept = joined.filter(idx.between(F.col("__keep_from"), F.col("__keep_to")))
    first, last = idx == F.col("__keep_from"), idx == F.col("__keep_to")
    line = F.col(line_col)
    line = F.when(first & last, F.btrim(line, F.lit(PY_SPACE))) \
        .when(first, F.ltrim(line, F.lit(PY_SPACE))) \
        .when(last, F.rtrim(line, F.lit(PY_SPACE))).otherwise(line)
    renumbered = idx - F.col("__keep_from") + F.col("__kept_before") + 1
    others = [c for c in lines.columns if c != line_col]
    return kept.select(*others, line.alias(line_col), renumbered.alias(index_col))


def read_pipe_records(spark: SparkSession, path: str, target_columns: Sequence[str], *,
                      strip_edges: bool = True, id_col: str = ID_KEY) -> DataFrame:
    """Pipe-delimited text files, one record per line, numbered in file order
    (files by path, lines in the order they are stored) without a shuffle.

    ``strip_edges`` treats each file like ``text.strip().split('\\n')``:
    leading/trailing blank lines are not records."""
    lines = read_lines(spark, path)
    if not strip_edges:
        return parse_pipe_records(lines, "line", target_columns, order_by=FILE_ORDER, id_col=id_col)
    records = number_stripped_lines(lines, "__id")
    return parse_pipe_records(records, "line", target_columns, order_by=None, id_col=id_col,
                              numbered=True)


def layout_columns(xml: Column, *, fixed: Sequence[str] = FIXED_COLUMNS,
                   exclude: Sequence[str] = (), malformed_fixed: bool = True) -> Column:
    """Ordered column list of an XML layout: ``fixed`` then the first ``name``
    of each direct ``field`` child of the root, in document order; nameless or
    empty names and ``exclude`` are skipped. Malformed XML gives ``fixed``
    (``malformed_fixed``) or an empty list."""
    # names keep their surrounding white space, as an XML text node does
    parsed = F.from_xml(xml, _LAYOUT_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record",
                                              "ignoreSurroundingSpaces": "false"})
    firsts = F.transform(F.coalesce(parsed["field"], F.array().cast("array<struct<name:array<string>>>")),
                         lambda f: F.try_element_at(f["name"], F.lit(1)))
    skip = F.array(*[F.lit(x) for x in exclude]).cast("array<string>")
    names = F.filter(firsts, lambda x: x.isNotNull() & (x != "") & ~F.array_contains(skip, x))
    prefix = F.array(*[F.lit(x) for x in fixed]).cast("array<string>")
    bad = F.array(*[F.lit(x) for x in fixed]) if malformed_fixed else F.array()
    return F.when(parsed["_corrupt_record"].isNotNull(), bad.cast("array<string>")) \
        .otherwise(F.concat(prefix, names))


def read_xml_layout(spark: SparkSession, path: str, **layout_args) -> DataFrame:
    """One row per layout file: ``path, columns`` (the whole file is one document)."""
    docs = spark.read.text(path, wholetext=True)
    return docs.select(F.col("_metadata.file_path").alias("path"),
                       layout_columns(F.col("value"), **layout_args).alias("columns"))


def layout_rows(layouts: DataFrame, id_col: str, columns_col: str = "columns") -> DataFrame:
    """``(id, pos, column_name)`` rows of layout lists, ``pos`` from 1."""
    return layouts.select(id_col, F.posexplode(columns_col).alias("__p", "column_name")) \
        .select(id_col, (F.col("__p") + 1).cast("long").alias("pos"), "column_name")


def layout_list(layout: DataFrame, columns_col: str = "columns") -> list[str]:
    """Column list of a single layout document, for use as a schema.

    A schema lives on the driver; this reads one row (one document). Several
    documents raise."""
    found = layout.select(columns_col).take(2)
    if len(found) > 1:
        raise ValueError("more than one layout document")
    return list(found[0][0]) if found and found[0][0] is not None else []


def empty_from_layout(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    """Empty frame whose columns are the layout's (all text)."""
    return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))


def load_by_layout(lines: DataFrame, line_col: str, layout: DataFrame, *, order_by,
                   columns_col: str = "columns") -> DataFrame:
    """Parse pipe records into the columns an XML layout lists."""
    return parse_pipe_records(lines, line_col, layout_list(layout, columns_col), order_by=order_by)
