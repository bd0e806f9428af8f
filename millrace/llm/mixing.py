"""Mixing sources to target weights by a low-discrepancy schedule.

All of it is DataFrame code: word counts come from a built-in, prefix sums are
two-level (totals per bucket first, then inside each bucket), so no source,
however large, is summed or numbered in one task.

1. Targets: sources share a budget by weight; none gets more than ``max_epochs``
   times its own size, the excess goes to the others by weight. That fixed
   point is ``min(cap, level * weight)``; the level comes from one cumulative
   sum over the sources ordered by ``cap / weight`` (one row per source).
2. Schedule: slot ``i`` of ``n`` takes the point ``frac(i * g)``, with ``g`` the
   golden ratio as a quotient of neighbouring Fibonacci numbers, exact in
   64-bit integers. The point falls into one interval of the cumulative
   targets, whose source owns the slot; slots are ranked per source.
3. Blocks: the documents of a source, in a shuffled order fixed by a hash of
   their id, are laid end to end ``max_epochs`` times and cut into blocks of
   equal word counts. The slot of rank ``r`` takes block ``r``.

Defined cases: null text has size 0; a null source is a source of its own and
comes last; documents of size 0 are never taken; rows that repeat a doc_id
in a source are separate documents of the stream, what is taken of them is added up (and cut, in
:func:`repeated`, as if it were one document); an empty table gives an empty
result; sources without words get target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .common import WORD_PATTERN, written

#: Weights by the rank of the source name, repeating.
WEIGHTS = (5, 2, 1)
#: Rows per bucket of the two-level sums, and slots per numbering range.
BUCKET_ROWS = 20_000
SLOT_RANGE = 65_536
#: Blocks hold about this many words, fewer for small inputs (see ``block_words``).
BLOCK_WORDS = 4096
LEAST_SLOTS = 131_072
MOST_SLOTS = 1 << 30


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, source, size`` (all texts, counted once)."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
                       word_count(docs["text"].cast("string")).alias("size"))


def targets(sizes: DataFrame, *, share: float = 1.5, max_epochs: int = 2, weights=WEIGHTS) -> DataFrame:
    """Per source: ``source, source_size, weight, target, lo, hi``; [lo, hi) is
    its interval of the cumulative targets, scaled to 1."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choice = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(choice, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    ratio = F.col("cap") / F.col("weight")
    before = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # the level if the sources before this one stand at their caps; the largest is the true one
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap"))
    per = per.withColumn("target", target)
    up_to = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("target").over(everything)
    per = per.withColumn("hi", F.sum("target").over(up_to) / total).withColumn(
        "lo", F.lag("hi", 1, 0.0).over(Window.orderBy(F.col("source").asc_nulls_last())))
    return per.select("source", "source_size", "weight", "target", "lo", "hi")


def block_words(total_target: float) -> int:
    """Words per block: 4096, less for small inputs so that even a small source
    owns many slots, more only where 2**30 slots would not hold the mix."""
    return max(1, min(BLOCK_WORDS, int(total_target / LEAST_SLOTS)), -(-int(total_target) // MOST_SLOTS))


def schedule(shares: DataFrame, slots: int) -> DataFrame:
    """``source, rank, slot``: the slots of each source, numbered from 0 in slot order."""
    spark = shares.sparkSession
    below, period = 1, 2
    while period < max(slots, 2):
        below, period = period, below + period
    cells = 1024  # points and intervals meet by cell, so the range test stays an equi-join
    points = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") * below % period / period).alias("u"))
    points = points.withColumn("cell", F.floor(F.col("u") * cells))
    last = F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1))
    pieces = shares.where("hi > lo").select(
        "source", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.greatest(last, F.floor(F.col("lo") * cells)))).alias("cell"))
    top = shares.agg(F.max("hi")).first()[0]
    inside = (F.col("u") >= F.col("lo")) & ((F.col("u") < F.col("hi")) | (F.col("hi") >= F.lit(top)))
    owned = points.join(broadcast_if_small(pieces), "cell").where(inside).select(
        "source", "slot", F.floor(F.col("slot") / SLOT_RANGE).alias("part"))
    counts = owned.groupBy("source", "part").count()
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("source", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("source", "part").orderBy("slot")) - 1
    ranked = owned.withColumn("within", within)
    return ranked.join(first, ranked["source"].eqNullSafe(first["source"]) & (ranked["part"] == first["part"])).select(
        ranked["source"], (F.col("first") + F.col("within")).alias("rank"), "slot")


def pieces_of(sizes: DataFrame, shares: DataFrame, words: int, max_epochs: int) -> DataFrame:
    """``source, rank, doc_id, epoch, length``: what each block holds of each document."""
    n = sizes.count()
    buckets = max(1, -(-n // BUCKET_ROWS))
    order = F.xxhash64(F.col("doc_id"), F.lit(42))
    docs = sizes.where("size > 0").withColumn("h", order).withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 1), F.lit(buckets)))
    totals = docs.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("of"), F.col("bucket").alias("at"),
                           F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inner = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    placed = placed.join(totals, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at")))
    sums = shares.select(F.col("source").alias("of"), "source_size")
    placed = placed.drop("of", "at").join(broadcast_if_small(sums), F.col("source").eqNullSafe(F.col("of")))
    placed = placed.select("source", "doc_id", "size", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"),
                           (F.col("base") + F.col("inner")).alias("base"), "source_size")
    begin = F.col("base") + F.col("epoch") * F.col("source_size")
    placed = placed.select("source", "doc_id", "epoch", begin.alias("begin"), (begin + F.col("size")).alias("end"))
    first, last = F.floor(F.col("begin") / words), F.floor((F.col("end") - 1) / words)
    cut = placed.withColumn("rank", F.explode(F.sequence(first, last)))
    length = F.least("end", (F.col("rank") + 1) * words) - F.greatest("begin", F.col("rank") * words)
    return cut.select("source", "rank", "doc_id", "epoch", length.alias("length"))


def mix(docs: DataFrame, *, share: float = 1.5, max_epochs: int = 2, weights=WEIGHTS):
    """The mix as two frames: ``sizes`` with each document's source target
    (``doc_id, source, size, source_size, target``) and ``schedule`` of taken pieces
    (``slot, source, rank, doc_id, epoch, length``)."""
    spark = docs.sparkSession
    sizes = written(sized(docs), spark, "mix-sizes")
    shares = written(targets(sizes, share=share, max_epochs=max_epochs, weights=weights), spark, "mix-targets")
    total = shares.agg(F.sum("target")).first()[0] or 0.0
    words = block_words(total)
    slots = max(1, round(total / words)) if total else 0
    ranked = schedule(shares, slots)
    pieces = pieces_of(sizes, shares, words, max_epochs)
    same = ranked["source"].eqNullSafe(pieces["source"]) & (ranked["rank"] == pieces["rank"])
    taken = ranked.join(pieces, same).select("slot", pieces["source"], pieces["rank"], "doc_id", "epoch", "length")
    right = shares.select(F.col("source").alias("of"), "source_size", "target")
    with_target = sizes.join(broadcast_if_small(right), sizes["source"].eqNullSafe(F.col("of"))).drop("of")
    return with_target, taken


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Per document row: ``doc_id, size, source_size, target, taken, source``. Rows that
    share doc_id and source show what is taken of them together."""
    sizes, taken = mix(docs, **options)
    per = taken.groupBy(F.col("doc_id").alias("of"), F.col("source").alias("from")).agg(F.sum("length").alias("words"))
    out = sizes.join(per, sizes["doc_id"].eqNullSafe(F.col("of")) & sizes["source"].eqNullSafe(F.col("from")), "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"), "source")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word and the gap after it."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")  # each word with its gap
    gap_first = F.regexp_like(text, F.lit(r"^[\x20\x09-\x0D]")).cast("int")  # a gap before the first word is a piece too
    return F.array_join(F.slice(pieces, 1, n.cast("int") + gap_first), "")


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each row as often as its taken words hold it whole, and once
    more, cut after the words that remain, where they hold a part; with all its columns.
    So each source brings exactly the words that the mix takes of it."""
    words = taken_words(docs, **options)
    times = words.groupBy("doc_id", "source").agg(F.first("taken").alias("taken"), F.sum("size").alias("size"))
    times = times.where("taken > 0").select(F.col("doc_id").alias("__of"), F.col("source").alias("__from"), "taken", "size")
    times = times.select("__of", "__from", F.floor(F.col("taken") / F.col("size")).cast("int").alias("__times"),
                         (F.col("taken") % F.col("size")).alias("__rest"))
    times = written(times, docs.sparkSession, "mix-times")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__of")) & docs["source"].cast("string").eqNullSafe(F.col("__from"))
    out = docs.join(broadcast_if_small(times), same)
    whole = F.sequence(F.lit(1), F.col("__times") + (F.col("__rest") > 0).cast("int"))
    out = out.withColumn("__copy", F.explode(whole))
    text = F.when(F.col("__copy") > F.col("__times"), first_words(out["text"].cast("string"), F.col("__rest"))).otherwise(out["text"])
    return out.withColumn("__text", text).select(*[F.col("__text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
