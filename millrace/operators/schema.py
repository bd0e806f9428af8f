"""Schema work: column-name cleaning, conforming to a target schema, DDL type
inference under three policies, and typed loads that split off rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType,
                               FloatType, IntegerType, LongType, ShortType, StringType, StructType,
                               TimestampNTZType, TimestampType, _parse_datatype_string)

from ..functions.text import clean_name


def clean_names(df: DataFrame) -> DataFrame:
    """Rename columns: space, '-' and '.' become '_'. Two columns cleaning to
    the same name is an error (the result would be ambiguous)."""
    new = [clean_name(c) for c in df.columns]
    dupes = sorted({c for c in new if new.count(c) > 1})
    if dupes:
        raise ValueError(f"column names collide after cleaning: {dupes}")
    return df.toDF(*new)


def _as_struct(schema: StructType | str) -> StructType:
    if isinstance(schema, StructType):
        return schema
    parsed = _parse_datatype_string(schema)
    if not isinstance(parsed, StructType):
        raise ValueError(f"not a row schema: {schema!r}")
    return parsed


def conform(df: DataFrame, target: StructType | str, *, strict_types: bool = False) -> DataFrame:
    """Exactly the target's columns in the target's order: missing columns are
    null, extra columns are dropped, present ones are cast (``try_cast``; with
    ``strict_types`` a failing value raises instead)."""
    target = _as_struct(target)
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in target.fields:
        src = have.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            c = F.col(f"`{src}`")
            cols.append((c.cast(f.dataType) if strict_types else c.try_cast(f.dataType)).alias(f.name))
    return df.select(*cols)


# DDL type policies (fixed values): integral, floating, boolean, date/time, rest.
POLICIES: Mapping[str, Mapping[str, str]] = {
    "int32": {"integral": "INT", "floating": "DOUBLE", "boolean": "BOOLEAN",
              "datetime": "STRING", "other": "STRING"},
    "int64": {"integral": "BIGINT", "floating": "DOUBLE", "boolean": "BOOLEAN",
              "datetime": "STRING", "other": "STRING"},
    "int64_ts": {"integral": "BIGINT", "floating": "DOUBLE", "boolean": "BOOLEAN",
                 "datetime": "TIMESTAMP", "other": "STRING"},
}


def type_family(dt: DataType) -> str:
    if isinstance(dt, (ByteType, ShortType, IntegerType, LongType)):
        return "integral"
    if isinstance(dt, DecimalType):
        return "integral" if dt.scale == 0 else "floating"
    if isinstance(dt, (FloatType, DoubleType)):
        return "floating"
    if isinstance(dt, BooleanType):
        return "boolean"
    if isinstance(dt, (DateType, TimestampType, TimestampNTZType)):
        return "datetime"
    return "other"


def infer_ddl(df: DataFrame, policy: str = "int64") -> DataFrame:
    """One row per column (``ordinal, column_name, data_type``) mapping the
    frame's (e.g. CSV-inferred) types through ``policy``. Nullable integer
    columns stay integral (Spark keeps them integral)."""
    table = POLICIES[policy]
    rows = [(i + 1, f.name, table[type_family(f.dataType)]) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, data_type string")


def ddl_columns(df: DataFrame, policy: str = "int64") -> list[tuple[str, str]]:
    """``(name, type)`` list for :func:`millrace.sources.tables.build_ddl`."""
    table = POLICIES[policy]
    return [(f.name, table[type_family(f.dataType)]) for f in df.schema.fields]


REASON = "_reject_reason"


def with_rejects(df: DataFrame, types: Mapping[str, str | DataType]) -> DataFrame:
    """Cast the named text columns with ``try_cast`` and add ``_reject_reason``:
    null for a good row, else the names of the columns whose non-empty text did
    not convert. Other columns pass through."""
    reasons = []
    cols = []
    for c in df.columns:
        if c in types:
            typed = F.col(f"`{c}`").try_cast(types[c])
            bad = F.col(f"`{c}`").isNotNull() & (F.trim(F.col(f"`{c}`")) != "") & typed.isNull()
            reasons.append(F.when(bad, F.lit(c)))
            cols.append(typed.alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    reason = F.concat_ws(",", *reasons) if reasons else F.lit("")
    return df.select(*cols, F.when(reason != "", reason).alias(REASON))


def split_rejects(df: DataFrame, types: Mapping[str, str | DataType]) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: typed good rows, and the original text rows that
    failed with their reason. A bad row never fails the whole load."""
    raw = df.select("*", F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__raw"))
    checked = with_rejects(raw, types)
    good = checked.filter(F.col(REASON).isNull()).drop(REASON, "__raw")
    rejects = checked.filter(F.col(REASON).isNotNull()).select("__raw.*", REASON)
    return good, rejects


def text_schema(columns: Sequence[str]) -> StructType:
    from pyspark.sql.types import StructField
    return StructType([StructField(c, StringType()) for c in columns])
