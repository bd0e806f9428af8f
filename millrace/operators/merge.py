"""Key-based upserts (three merge rules) and row consolidation by key.

The three rules differ on purpose and are not interchangeable:

* ``upsert_replace``  -- every delta row, plus target rows whose key is not in
  the delta. A null delta cell writes null; duplicate delta keys are all kept
  (``dedupe_by`` keeps only the latest per key).
* ``upsert_coalesce`` -- per shared column the delta value wins unless it is
  null; columns the delta lacks keep the old value; delta-only columns are
  dropped. Duplicate delta keys fan out, one result row each.
* ``upsert_update``   -- conflict-update: delta columns overwrite by presence
  (a null delta cell does overwrite), absent columns keep the old value, and
  among duplicate delta keys the last one by ``order_by`` wins.

Null keys never match, so a null-key row of either side survives unchanged.

Plan shape, chosen from a proven bound on the delta's row count:

* small delta (the usual daily change set): the target is streamed once
  against the broadcast delta -- no shuffle of the target at all. New keys are
  ``delta ANTI JOIN (target SEMI JOIN delta-keys)``; the semi join reads only
  the target's key columns and returns at most the delta's key count.
* large delta: ``upsert_update`` is one full outer join (its delta keys are
  unique after a map-side ``max(struct)`` reduction, and target keys are unique
  as a primary key), shuffling each side once. ``upsert_coalesce`` keeps
  duplicate delta keys (fan-out), so it is ``delta LEFT JOIN target`` plus
  ``target ANTI JOIN delta-keys``: AQE can split a delta key holding a third
  of the rows, which a full outer join cannot.

Anti and semi joins always use the delta's *distinct* keys, aggregated
map-side first, so a hot key is one row per task before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip
from ..plans.joins import DEFAULT_BROADCAST_ROWS, bounded_rows

_D = "__d__"  # prefix of delta columns inside a merge


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _resolve(df: DataFrame, name: str) -> str | None:
    """Column of ``df`` matching ``name`` under the session's case rule."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    for c in df.columns:
        if c == name or (not sensitive and c.lower() == name.lower()):
            return c
    return None


def _check_keys(target: DataFrame, delta: DataFrame, keys: list[str]) -> None:
    for k in keys:
        if _resolve(target, k) is None:
            raise ValueError(f"key column {k!r} is not in the target")
        if _resolve(delta, k) is None:
            raise ValueError(f"key column {k!r} is not in the delta")


def delta_report(target: DataFrame, delta: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row on whether a delta can be merged: ``status`` (``ok``, ``empty``, or ``no key`` where a key
    column is missing on either side), ``rows`` and ``null_keys`` of the delta."""
    names = _names(keys)
    missing = [k for k in names if _resolve(target, k) is None or _resolve(delta, k) is None]
    null_key = F.lit(False)
    for k in names if not missing else []:
        null_key = null_key | F.col(f"`{_resolve(delta, k)}`").isNull()
    counts = delta.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(null_key, 1)).alias("null_keys"))
    status = F.lit("no key") if missing else F.when(F.col("rows") == 0, "empty").otherwise("ok")
    return counts.select(status.alias("status"), "rows", "null_keys")


def conform_delta(target: DataFrame, delta: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Delta columns shared with the target, renamed to target names and cast to
    target types with ``try_cast`` (ANSI ``coalesce('abc', 1)`` would fail at run
    time). Returns the frame (columns prefixed) and the shared non-key names."""
    types = {f.name: f.dataType for f in target.schema.fields}
    shared: list[str] = []
    cols: list[Column] = []
    for name in target.columns:
        src = _resolve(delta, name)
        if src is None:
            continue
        cols.append(F.col(f"`{src}`").try_cast(types[name]).alias(_D + name))
        if name not in keys:
            shared.append(name)
    return delta.select(*cols), shared


_T = "__t__"  # prefix of target columns inside a merge


def _key_cond(keys: list[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col(_D + k) == F.col(_T + k)
        cond = c if cond is None else cond & c
    return cond


def _prefixed(target: DataFrame) -> DataFrame:
    """Target columns renamed, so merge expressions refer to names only (the
    delta is often derived from the target's own scan)."""
    return target.select(*[F.col(f"`{c}`").alias(_T + c) for c in target.columns])


def _delta_keys(d: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct delta keys (duplicates collapse map-side before the shuffle)."""
    return d.select(*[_D + k for k in keys]).distinct()


def _unmatched_target(target: DataFrame, d: DataFrame, keys: list[str], small: bool) -> DataFrame:
    t = _prefixed(target)
    dk = _delta_keys(d, keys)
    rows = t.join(F.broadcast(dk) if small else dk, _key_cond(keys), "left_anti")
    return rows.select(*[F.col(_T + c).alias(c) for c in target.columns])


def _bounded(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """``(df, True)`` when ``df`` provably has at most ``max_rows`` rows; the
    frame is cached for the check so it is not computed twice."""
    cached = df.cache()
    if bounded_rows(cached, max_rows):
        return cached, True
    cached.unpersist()
    return df, False


def latest_by_key(df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` value (last wins).

    ``max(struct(order..., rest...))`` is a plain aggregate, so Spark combines
    rows map-side before the shuffle: a key holding a third of all rows leaves
    each map task as a single row. Ties on ``order_by`` are broken by the
    remaining columns, which keeps the result deterministic.
    """
    keys = _names(keys)
    order = _names(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.max(packed).alias("__best"))
    picked = [F.col(f"__best.o{i}").alias(c) for i, c in enumerate(order)]
    picked += [F.col(f"__best.{c}").alias(c) for c in rest]
    out = best.select(*keys, *picked)
    return out.select(*df.columns)


def latest_values(df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """One row per key: each column's last value by ``order_by`` that is not null, as if the
    rows were merged one after the other by the coalescing rule. Combined map-side."""
    keys, order = _names(keys), _names(order_by)
    seq = [F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)]
    rest = [c for c in df.columns if c not in keys]
    last = [F.max(F.when(F.col(f"`{c}`").isNotNull(), F.struct(*seq, F.col(f"`{c}`").alias("v"))))["v"].alias(c) for c in rest]
    return df.groupBy(*keys).agg(*last).select(*df.columns)


def upsert_replace(target: DataFrame, delta: DataFrame, keys: str | Sequence[str], *,
                   dedupe_by: str | Sequence[str] | None = None,
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Replace merge: ``delta ∪ (target ANTI JOIN delta ON keys)``.

    Delta rows are aligned to the target schema by name; a target column the
    delta lacks becomes null (the rule assumes equal schemas).
    """
    keys = _names(keys)
    _check_keys(target, delta, keys)
    if dedupe_by is not None:
        delta = latest_by_key(delta, keys, dedupe_by)
    d, _ = conform_delta(target, delta, keys)
    small = bounded_rows(_delta_keys(d, keys), broadcast_rows)
    types = {f.name: f.dataType for f in target.schema.fields}
    new_rows = d.select(*[(F.col(_D + c) if _D + c in d.columns else F.lit(None).cast(types[c])).alias(c)
                          for c in target.columns])
    return new_rows.unionByName(_unmatched_target(target, d, keys, small))


def _pick(c: str, keys: list[str], shared: list[str], rule: str, hit: Column) -> Column:
    if c in keys:
        return F.when(hit, F.col(_D + c)).otherwise(F.col(_T + c)).alias(c)
    if c in shared and rule == "coalesce":
        return F.coalesce(F.col(_D + c), F.col(_T + c)).alias(c)
    if c in shared:
        return F.when(hit, F.col(_D + c)).otherwise(F.col(_T + c)).alias(c)
    return F.col(_T + c).alias(c)


def _merge(target: DataFrame, d: DataFrame, keys: list[str], shared: list[str], rule: str,
           broadcast_rows: int) -> DataFrame:
    d = d.withColumn("__hit", F.lit(True))
    hit = F.col("__hit").isNotNull()
    t = _prefixed(target)
    d, small = _bounded(d, broadcast_rows)
    cols = [_pick(c, keys, shared, rule, hit) for c in target.columns]
    if small:
        # every target row once, merged with its (broadcast) delta rows
        merged = t.join(F.broadcast(d), _key_cond(keys), "left").select(*cols)
        # delta rows whose key is not in the target: match keys are <= |delta|
        dk = _delta_keys(d, keys)
        found = t.join(F.broadcast(dk), _key_cond(keys), "left_semi") \
            .select(*[F.col(_T + k).alias(_D + k) for k in keys]).distinct()
        fresh = d.join(F.broadcast(found), [_D + k for k in keys], "left_anti")
        fresh = fresh.select(*[F.col(f"`{c}`") for c in d.columns],
                             *[F.lit(None).cast(f.dataType).alias(_T + f.name) for f in target.schema.fields])
        return merged.unionByName(fresh.select(*cols))
    if rule == "update":
        # unique keys on both sides: one full outer join, each side shuffled once
        return d.join(t, _key_cond(keys), "full_outer").select(*cols)
    matched = d.join(t, _key_cond(keys), "left").select(*cols)
    return matched.unionByName(_unmatched_target(target, d, keys, False))


def upsert_coalesce(target: DataFrame, delta: DataFrame, keys: str | Sequence[str], *,
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Coalescing merge (new non-null value wins per column)."""
    keys = _names(keys)
    _check_keys(target, delta, keys)
    d, shared = conform_delta(target, delta, keys)
    return _merge(target, d, keys, shared, "coalesce", broadcast_rows)


def upsert_update(target: DataFrame, delta: DataFrame, keys: str | Sequence[str], *,
                  order_by: str | Sequence[str] | None = None,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Conflict-update merge: update the delta's columns, insert new keys.

    With ``order_by`` the delta is first reduced to its last row per key; without
    it the delta keys must already be unique.
    """
    keys = _names(keys)
    _check_keys(target, delta, keys)
    if order_by is not None:
        delta = latest_by_key(delta, keys, order_by)
    d, shared = conform_delta(target, delta, keys)
    return _merge(target, d, keys, shared, "update", broadcast_rows)


def merge_rows(df: DataFrame, key: str, columns: Sequence[str] | None = None, *,
               sep: str = " ", order_by_key: bool = True) -> DataFrame:
    """Consolidate rows by ``key``: per column, the distinct non-blank values
    (trimmed like Python ``strip``), sorted as text and joined by ``sep``; a
    column with no value becomes ``''``.

    The key is compared as text; rows with a null or empty key are dropped (a
    key of spaces is kept, it is not trimmed). ``collect_set`` is combined
    map-side, so a hot key reaches the final task as its distinct values only;
    the final string per key is the output itself. Text order is code-point
    order (Spark compares UTF-8 bytes, which orders code points identically).
    """
    columns = [c for c in (columns or df.columns) if c != key]
    k = F.col(key).cast("string")
    rows = df.filter(k.isNotNull() & (k != F.lit(""))) \
        .select(k.alias(key), *[py_strip(F.col(c).cast("string")).alias(c) for c in columns])
    aggs = [F.concat_ws(sep, F.sort_array(F.collect_set(
        F.when(F.col(c) != "", F.col(c))))).alias(c) for c in columns]
    out = rows.groupBy(key).agg(*aggs)
    return out.orderBy(key) if order_by_key else out
