"""Join-side helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Bounds under which a side is shipped to every task: at most 2M rows and
# 256 MB of data, well below executor memory. Anything larger is joined by
# shuffle (and AQE may still convert it once it has measured the real size).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def _row_bytes(df: DataFrame):
    """Per-row size estimate: text and binary by their actual byte length,
    nested values by their JSON text, everything else 8 bytes."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(8))
    total = F.lit(0).cast("long")
    for p in parts:
        total = total + p
    return total


def bounded_rows(df: DataFrame, max_rows: int, max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (and about ``max_bytes``
    bytes of data).

    Runs one aggregate over ``limit(max_rows + 1)``: the scan stops early on
    big inputs, so the check costs at most ``max_rows + 1`` rows of work.
    """
    probe = df.limit(max_rows + 1)
    if max_bytes is None:
        return probe.count() <= max_rows
    row = probe.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, *,
                       cache: bool = False) -> DataFrame:
    """Mark ``df`` for broadcast only when its row count is proven small.

    ``cache`` keeps a derived side (an aggregate) from being computed twice:
    once for the check and once for the join."""
    if cache:
        df = df.cache()
    return F.broadcast(df) if bounded_rows(df, max_rows) else df
