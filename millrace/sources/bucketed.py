"""Tables bucketed by key, merged with large deltas without shuffling the table.

The table is written in buckets of its key, sorted inside. A delta of any size is dealt to the
same buckets, so each rule of :mod:`millrace.operators.merge` becomes a sort-merge join in
which only the delta moves: the table's side has no exchange. A merged table is written
in the same buckets beside the old one; the name then points to it.

A bucket is one task: choose as many buckets as keep them well below an executor's memory. A
delta key that many rows share (which the coalescing rule returns one by one) lies in one
of them; :mod:`millrace.operators.merge` splits such keys at the price of a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from ..session import scratch_path, unique_name


class BucketedTable:
    """A catalog table bucketed and sorted by ``keys``."""

    def __init__(self, spark: SparkSession, name: str, keys: str | Sequence[str], *, buckets: int):
        self.spark, self.name, self.buckets = spark, name, buckets
        self.keys = [keys] if isinstance(keys, str) else list(keys)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def write(self, rows: DataFrame) -> None:
        """The table with ``rows`` as its content, in a place of its own; rows that come in the
        table's buckets already are not moved again."""
        draft = unique_name(f"{self.name}_draft")
        rows.repartition(self.buckets, *self.keys).write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option(
            "path", scratch_path(self.spark, self.name)).saveAsTable(draft)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(f"ALTER TABLE {draft} RENAME TO {self.name}")

    def dealt(self, delta: DataFrame) -> DataFrame:
        """``delta`` in the table's buckets."""
        return delta.repartition(self.buckets, *self.keys)

    def merged(self, delta: DataFrame, rule: str, *, order_by: Sequence[str] = ()) -> DataFrame:
        """The table after a merge by ``replace``, ``coalesce`` or ``update`` (last row per key by
        ``order_by``), not written yet. Null keys never match: both sides' rows stay."""
        target = self.rows()
        if rule == "update" and order_by:
            delta = merge.latest_by_key(delta, self.keys, order_by)
        types = {f.name: f.dataType for f in target.schema.fields}
        shared = [c for c in target.columns if c in delta.columns]
        for k in self.keys:
            if k not in shared:
                raise ValueError(f"key column {k!r} is not in the delta")
        d = self.dealt(delta.select(*[F.col(c).try_cast(types[c]).alias(c) for c in shared])).alias("d")
        t = target.hint("merge").alias("t")
        same = reduce(lambda a, b: a & b, [F.col(f"d.{k}") == F.col(f"t.{k}") for k in self.keys])
        if rule == "replace":
            keys = d.select(*[F.col(f"d.{k}").alias(k) for k in self.keys]).distinct().alias("d")
            kept = t.join(keys, same, "left_anti").select("t.*")
            new = [F.col(f"d.{c}") if c in shared else F.lit(None).cast(types[c]).alias(c) for c in target.columns]
            return kept.unionByName(d.select(*new))
        if rule not in ("coalesce", "update"):
            raise ValueError(f"unknown merge rule {rule!r}")
        hit = F.col("d.__hit").isNotNull()
        d = d.select("d.*", F.lit(True).alias("__hit")).alias("d")

        def cell(c: str) -> Column:
            if c in self.keys:
                return F.when(hit, F.col(f"d.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            if c not in shared:
                return F.col(f"t.{c}").alias(c)
            both = F.coalesce(f"d.{c}", f"t.{c}") if rule == "coalesce" else F.when(hit, F.col(f"d.{c}")).otherwise(F.col(f"t.{c}"))
            return both.alias(c)

        return t.join(d, same, "full_outer").select(*[cell(c) for c in target.columns])

    def merge(self, delta: DataFrame, rule: str, *, order_by: Sequence[str] = ()) -> None:
        self.write(self.merged(delta, rule, order_by=order_by))
