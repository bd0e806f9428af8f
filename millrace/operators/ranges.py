"""Ranges of an order as literals: numbers, running sums and pages without a global
window and without writing the rows.

Three steps, each over the source itself:

1. A sample of the order keys, those with the smallest hash of row and place
   (partial samples merge, so tasks keep the smallest only). Every so-many-th of the
   sorted sample is a bound; a row hash as last part of the key cuts long ties.
2. With the bounds as a literal, a row finds its range by binary search, the same one
   in every job. Counts (or sums) per range give each range what lies before it.
3. Rows are numbered inside their ranges, the only shuffle, and moved by that.

Since the bounds are fixed numbers in the plan, a recomputed partition or a second scan
deals every row to the same range; nothing rests on a reused exchange or on written
rows. Only the sample and one number per range pass the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructType, TimestampType, VariantType

MOST_RANGES = 4096
ROWS_PER_RANGE = 250_000  # a larger input gets more ranges, and a task for each
PER_RANGE = 32  # sampled keys per range
RANGE = "__range"


class NotRangeable(ValueError):
    """The order has parts that cannot be written as literals (descending or nested ones)."""


def _literal(text: str | None, kind: DataType) -> str:
    """SQL for a value given by its text."""
    if text is None:
        return f"CAST(NULL AS {kind.simpleString()})"
    return f"CAST(CAST(X'{text.encode().hex()}' AS STRING) AS {kind.simpleString()})"


class Ranges:
    """Ranges of ``df`` by ``order`` (ascending columns; nulls first). ``weight`` replaces the
    count of 1 a row; ``tie_break`` adds the row's hash to the order."""

    def __init__(self, df: DataFrame, order: Sequence[Column], *, tie_break: bool = True, ranges: int | None = None, weight: Column | None = None):
        self.df, self.weight = df, weight
        spark = df.sparkSession
        if any(str(c).endswith((" NULLS FIRST'>", " NULLS LAST'>")) for c in order):
            raise NotRangeable("an order with directions of its own")
        row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        try:
            types = df.select(*[c.alias(f"k{i}") for i, c in enumerate(order)]).schema
            # by values whose text stands for them: microseconds (no time zone), hexadecimal digits
            plain = {TimestampType: F.unix_micros, BinaryType: F.hex}
            keys = [plain.get(type(f.dataType), lambda x: x)(c) for c, f in zip(order, types, strict=True)]
            keys += [row_hash] if tie_break else []
            schema = df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).schema
        except Exception as e:
            raise NotRangeable(f"no plain ascending order: {e}") from e
        if any(isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)) for f in schema):
            raise NotRangeable("an order by nested values")
        self.keys = keys
        self.key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
        self.tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(1, min(MOST_RANGES, ranges or max(4 * self.tasks, -(-df.count() // ROWS_PER_RANGE))))
        self.bounds = self._bounds(schema, row_hash, wanted)
        amount = F.sum(weight) if weight is not None else F.count(F.lit(1))
        per = {r[RANGE]: r for r in df.groupBy(self.range().alias(RANGE)).agg(amount.alias("n"), F.count(F.lit(1)).alias("rows")).collect()}  # one row per range
        self.rows = sum(r["rows"] for r in per.values())
        self.sums = [per[i]["n"] or 0 if i in per else 0 for i in range(len(self.bounds) + 1)]
        *self.before, self.total = accumulate(self.sums, initial=0)

    def _bounds(self, schema: StructType, row_hash: Column, wanted: int) -> list[str]:
        """Up to ``wanted - 1`` bounds as SQL literals, from a sample bounded by ``PER_RANGE``."""
        if wanted == 1:
            return []
        place = F.xxhash64(row_hash, F.monotonically_increasing_id())
        sample = self.df.select(*[k.alias(f"k{i}") for i, k in enumerate(self.keys)], place.alias("place"))
        sample = sample.orderBy("place").limit(wanted * PER_RANGE)
        names = [f.name for f in schema]
        ordered = sample.orderBy(*names).select(*[F.col(n).cast("string") for n in names]).collect()
        step = max(1, len(ordered) // wanted)
        chosen = list(dict.fromkeys(tuple(r) for r in ordered[step::step]))
        return ["named_struct(" + ", ".join(f"'{f.name}', {_literal(v, f.dataType)}" for f, v in zip(schema, r, strict=True)) + ")" for r in chosen]

    def range(self) -> Column:
        """The number of the row's range, from 0: how many bounds its key has reached."""
        if not self.bounds:
            return F.lit(0)
        steps = len(self.bounds).bit_length()
        bounds = F.expr(f"array({', '.join(self.bounds)})")
        start = F.struct(F.lit(0).alias("lo"), F.lit(len(self.bounds)).alias("hi"), self.key.alias("key"))

        def halved(a: Column, _: Column) -> Column:
            mid = F.shiftright(a["lo"] + a["hi"], 1)
            reached = F.get(bounds, mid) <= a["key"]
            done = a["lo"] >= a["hi"]
            return F.struct(F.when(~done & reached, mid + 1).otherwise(a["lo"]).alias("lo"),
                            F.when(~done & ~reached, mid).otherwise(a["hi"]).alias("hi"), a["key"].alias("key"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halved, lambda a: a["lo"])

    def _dealt(self) -> DataFrame:
        """``df`` with its ranges. Where the session's shuffle partitions would hold more than
        ``ROWS_PER_RANGE`` rows each, the ranges are dealt to as many tasks as there are ranges."""
        out = self.df.withColumn(RANGE, self.range())
        large = len(self.sums) > self.tasks and self.rows > ROWS_PER_RANGE * self.tasks
        return out.repartition(len(self.sums), RANGE) if large else out

    def _offset(self) -> Column:
        return F.get(F.expr(f"array({', '.join(f'{int(n)}L' for n in self.before)})"), F.col(RANGE))

    def numbered(self, name: str) -> DataFrame:
        """``df`` with 1..N in order: the rows are sorted once, within their ranges."""
        within = F.row_number().over(Window.partitionBy(RANGE).orderBy(*self.keys))
        return self._dealt().withColumn(name, (self._offset() + within).cast("long")).drop(RANGE)

    def running(self, name: str) -> DataFrame:
        """``df`` with the sum of the weights of all rows before it in order."""
        earlier = Window.partitionBy(RANGE).orderBy(*self.keys).rowsBetween(Window.unboundedPreceding, -1)
        inner = F.coalesce(F.sum(self.weight).over(earlier), F.lit(0))
        return self._dealt().withColumn(name, (self._offset() + inner).cast("long")).drop(RANGE)

    def page(self, offset: int, limit: int) -> DataFrame:
        """Rows ``offset + 1 .. offset + limit`` in order. The counts name the ranges that hold
        them; the others are filtered out before anything is sorted."""
        hold = [i for i, (b, n) in enumerate(zip(self.before, self.sums, strict=True)) if n and b < offset + limit and b + n > offset]
        if not hold or limit <= 0:
            return self.df.limit(0)
        part = self.df.where(self.range().between(hold[0], hold[-1]))
        return part.orderBy(*self.keys).offset(offset - self.before[hold[0]]).limit(limit)
