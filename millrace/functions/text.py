"""Scalar column helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes: every code point for which
# str.isspace() is true (derived from the rule, not listed by hand).
PY_SPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# White space as `diff -w` sees it (C isspace): space, \t, \n, \v, \f, \r.
_C_SPACE = r"[ \t\n\x0B\f\r]"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """Trim white space at both ends the way Python's ``str.strip()`` does
    (``btrim`` with a character set: no regular expression per value)."""
    return F.btrim(col_of(c), F.lit(PY_SPACE))


def nonblank(c: str | Column) -> Column:
    """True when the value is non-null and not only white space."""
    c = col_of(c)
    return c.isNotNull() & (py_strip(c) != F.lit(""))


def drop_c_space(c: str | Column) -> Column:
    """Remove every white-space character (``diff -w`` semantics)."""
    return F.regexp_replace(col_of(c), _C_SPACE, "")


def serial(n: str | Column, width: int = 2) -> Column:
    """Zero-padded serial number, ``%02d`` style (``lpad`` would truncate 123)."""
    return F.format_string(f"%0{width}d", col_of(n))


def base_name(path: str | Column) -> Column:
    """Last path component of a file path or URI."""
    return F.element_at(F.split(col_of(path), "/"), -1)


def extension(path: str | Column) -> Column:
    """Lower-cased extension after the last dot of the base name ('' if none)."""
    return F.lower(F.regexp_extract(base_name(path), r"\.([^./]+)$", 1))


_NAME_CHARS = re.compile(r"[ \-.]")


def clean_name(name: str) -> str:
    """Column-name cleaning: space, '-' and '.' become '_'."""
    return _NAME_CHARS.sub("_", name)
