"""Labelled SQL step scripts run through ``spark.sql``.

Two script styles are accepted:

* labelled blocks -- ``-- @label: name`` starts a block, the rest of the line
  is the label and everything up to the next label is the step;
* statements -- split on ``;`` (outside quotes and comments), each optionally
  preceded by a ``-- @label:`` line; unlabelled ones get a default label.

Steps whose text is only comments are dropped (Spark would reject them).
Parameters are bound with named markers (``:name``) instead of text
formatting. A SELECT step's result becomes a temporary view named after its
label, so later steps can read it without a staging table; the last step's
result is returned. The script text is small and is split on the driver; the
data work of every step is an ordinary distributed Spark plan.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

LABEL_MARK = "-- @label:"
DEFAULT_LABEL = "Unlabeled Statement"
_LABEL_LINE = re.compile(r"^\s*--\s*@label:\s*(.*)$", re.MULTILINE)
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")
_QUERY = re.compile(r"^\s*(SELECT|WITH|VALUES|TABLE|FROM)\b", re.IGNORECASE)


@dataclass(frozen=True)
class Step:
    label: str
    sql: str


#: One piece of SQL text: a quoted stretch (a backslash escapes in strings, names double their
#: quote), a comment, a semicolon, or other text. An open quote or comment runs to the end.
_PIECE = re.compile(r"""(?P<quoted>'(?:\\.|[^'\\])*(?:'|$)|"(?:\\.|[^"\\])*(?:"|$)|`[^`]*(?:`|$))"""
                    r"""|(?P<comment>--[^\n]*|/\*.*?(?:\*/|$))|(?P<end>;)|(?P<other>[^'"`;/-]+|.)""", re.S)


def _strip_comments(sql: str) -> str:
    """SQL text without ``--`` line comments and ``/* */`` blocks (quote-aware)."""
    return "".join(m[0] for m in _PIECE.finditer(sql) if m.lastgroup != "comment")


def is_empty_sql(sql: str) -> bool:
    return _strip_comments(sql).strip().strip(";").strip() == ""


def split_statements(script: str) -> list[str]:
    """Split on ``;`` outside quotes and comments."""
    parts = [""]
    for m in _PIECE.finditer(script):
        if m.lastgroup == "end":
            parts.append("")
        else:
            parts[-1] += m[0]
    return [p.strip() for p in parts if p.strip()]


def labelled_blocks(script: str) -> list[Step]:
    """Blocks started by ``-- @label:`` lines (label = rest of that line)."""
    steps = []
    for block in script.split(LABEL_MARK):
        if not block.strip():
            continue
        head, _, body = block.strip().partition("\n")
        body = body.strip()
        if body.endswith(";"):
            body = body[:-1].rstrip()
        if not is_empty_sql(body):
            steps.append(Step(head.strip(), body))
    return steps


def labelled_statements(script: str) -> list[Step]:
    """``;``-separated statements with an optional leading label line."""
    steps = []
    for stmt in split_statements(script):
        m = _LABEL_LINE.match(stmt)
        label = DEFAULT_LABEL
        if m:
            label = m.group(1).strip()
            stmt = stmt[:m.start()] + stmt[m.end():]
        stmt = stmt.strip()
        if not is_empty_sql(stmt):
            steps.append(Step(label, stmt))
    return steps


def parse_script(script: str, style: str = "blocks") -> list[Step]:
    if style == "blocks":
        return labelled_blocks(script)
    if style == "statements":
        return labelled_statements(script)
    raise ValueError("style must be 'blocks' or 'statements'")


def run_sql_steps(spark: SparkSession, script: str, *, args: Mapping[str, object] | None = None,
                  views: Mapping[str, DataFrame] | None = None, style: str = "blocks") -> DataFrame | None:
    """Run the steps in order, stop at the first error (it propagates with the
    step label), and return the result of the last step.

    ``views`` are registered as temporary views first (e.g. the input tables).
    """
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    result = None
    for step in parse_script(script, style):
        code = _strip_comments(step.sql)
        used = {k: v for k, v in (args or {}).items() if re.search(rf":{re.escape(k)}\b", code)}
        try:
            result = spark.sql(step.sql, args=used or None)
        except Exception as exc:  # re-raised with the label for the caller
            raise RuntimeError(f"SQL step {step.label!r} failed: {exc}") from exc
        if _QUERY.match(code) and _IDENT.match(step.label):
            result.createOrReplaceTempView(step.label)
    return result
