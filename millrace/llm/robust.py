"""Quality rules: base counts of each text, and robust multivariate outliers.

All of it is DataFrame code. The counts of a text (words, their code points,
symbols, repeated lines, words in repeated three-word windows) become a vector
of five transformed statistics, in whole thousandths, so that sums over rows are
exact and do not depend on their order. Per language and source the vectors get a
minimum-covariance-determinant estimate:

1. Start from medians and quartile ranges.
2. Concentration steps: the share ``SUBSET`` of the rows that lie nearest by
   Mahalanobis distance gives the next mean and covariance, which cannot have a larger
   determinant. A step is one pass: rows are summed by group and distance bin
   before the shuffle, and the nearest bins of each group are added up.
3. The covariance is scaled so that the median distance is that of a normal
   sample, rows within ``REWEIGHT`` of it give the final estimate, scaled anew.

A document that passes the base rules is rejected when its squared distance lies
beyond ``CUT``. Variances have a floor of the least spread that matters, so a
statistic that most documents share exactly (no symbols at all) still has a scale.
A language and source with fewer than ``LEAST_ROWS`` documents uses the estimate of its
language, a small language that of all documents; a table with fewer documents
than that rejects by the base rules alone.

Defined cases: null and empty texts have no words and fail the base rules; a
null language or source is one of its own; rows that repeat a doc_id are
judged each by itself; groups whose statistics are all alike keep every document
(the floor is their scale); equal distances share a bin, so ties stay together;
an empty table gives an empty result; other columns play no part. Windows of
three words are compared by a 64-bit hash within their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .common import written

_GAP = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

#: The statistics, in thousandths, and the least spread of each that matters.
STATISTICS = ("length", "word_length", "symbols", "lines", "repeats")
FLOORS = (100.0, 20.0, 300.0, 300.0, 50.0)
DIM = len(STATISTICS)
SUBSET = 0.75
STEPS = 3
LEAST_ROWS = 100
BINS = 64.0  # bins per unit of log(1 + squared distance)
CHI_MEDIAN = 4.351  # of a chi-square of five degrees
REWEIGHT = 12.83  # its 97.5 % point
CUT = 50.0  # its tail beyond is about 1e-9


def counted(docs: DataFrame) -> DataFrame:
    """Per document the base counts: ``doc_id, lang, source, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words``."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("lang"),
                       docs["source"].cast("string").alias("source"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    rows = rows.select("doc_id", "lang", "source", F.array_remove(F.split("text", _GAP), "").alias("words"),
                       lines.alias("lines"), F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    n = F.size("words")
    windows = F.when(n >= WINDOW, F.transform(
        F.slice("words", 1, F.greatest(n - (WINDOW - 1), F.lit(0))), lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))))
    rows = rows.select("doc_id", "lang", "source", n.cast("long").alias("n_words"),
                       F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), windows.alias("windows"))
    # most texts repeat no window: only the others are sorted
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("placed", placed).drop("windows")
    twice = F.filter("placed", lambda x, k: (x["h"] == F.get("placed", k - 1)["h"]) | (x["h"] == F.get("placed", k + 1)["h"]))
    at = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        at, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("placed")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def statistics(counts: DataFrame) -> DataFrame:
    """The counts with ``base_failed`` and the transformed statistics ``x0, x1, ...``."""
    n = F.greatest("n_words", F.lit(1))
    values = [F.log1p(n), F.log(F.greatest("word_chars", F.lit(1)) / n), F.log1p(100 * F.col("n_symbols") / n),
              F.log1p("n_dup_lines"), F.col("n_repeat_words") / n]
    return counts.select("*", base_failed().alias("base_failed"),
                         *[F.round(1000 * v).cast("long").alias(f"x{i}") for i, v in enumerate(values)])


def _key(level: int, *parts: str) -> Column:
    """One text per group, different for different groups, nulls included."""
    return F.to_json(F.struct(F.lit(level).alias("level"), *[F.col(p).alias(p) for p in parts]))


def routed(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``route``: per language and source the group that judges it (null: none);
    ``members``: the groups to whose estimates it adds. One row per source, or few."""
    sizes = rows.where("not base_failed").groupBy("lang", "source").count()
    sizes = written(sizes, rows.sparkSession, "group-sizes")
    langs = sizes.groupBy("lang").agg(F.sum("count").alias("of_lang"))
    total = F.broadcast(sizes.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("of_all")))  # one row
    own = sizes.select("lang", "source", "count").join(langs.withColumnRenamed("lang", "of"), F.col("lang").eqNullSafe(F.col("of"))).drop("of")
    own = own.join(total).withColumn("route", F.when(F.col("count") >= least, _key(0, "lang", "source")).when(
        F.col("of_lang") >= least, _key(1, "lang")).when(F.col("of_all") >= least, _key(2)))
    own = written(own.select("lang", "source", "route"), rows.sparkSession, "routes")
    needed = own.select(F.col("route").alias("key")).where("key is not null").distinct()
    every = own.select("lang", "source", F.explode(F.array(_key(0, "lang", "source"), _key(1, "lang"), _key(2))).alias("key"))
    return own, every.join(needed, "key", "left_semi")


def _same_group(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join of rows with a table of one row (or few) per language and source."""
    small = right.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    return left.join(broadcast_if_small(small), F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")),
                     how).drop("of_lang", "of_source")


_DIMS = range(DIM)
_ENTRIES = [(i, j) for i in _DIMS for j in range(i + 1)]


def started(members: DataFrame) -> DataFrame:
    """Per group: rounded medians ``c0..`` (all later sums are taken from there), means
    ``mu0..`` of 0 and the inverse spreads ``m00..`` of the quartile ranges."""
    # the vectors are whole numbers of few values, so exact percentiles are merged from counts
    per = members.groupBy("key").agg(*[F.percentile(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"p{i}") for i in _DIMS])
    spread = [F.greatest((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, F.lit(FLOORS[i])) for i in _DIMS]
    return per.select("key", *[F.round(F.col(f"p{i}")[1]).cast("long").alias(f"c{i}") for i in _DIMS], *[F.lit(0.0).alias(f"mu{i}") for i in _DIMS],
                      *[(1 / spread[i] if i == j else F.lit(0.0)).alias(f"m{i}{j}") for i, j in _ENTRIES])


def measured(rows: DataFrame) -> DataFrame:
    """Rows joined to their estimate, with the squared distance ``d2`` and its ``bin``."""
    rows = rows.withColumns({f"y{i}": F.col(f"x{i}") - F.col(f"c{i}") for i in _DIMS})
    rows = rows.withColumns({f"t{i}": F.col(f"y{i}") - F.col(f"mu{i}") for i in _DIMS})
    rows = rows.withColumns({f"z{i}": sum((F.col(f"m{i}{j}") * F.col(f"t{j}") for j in range(i + 1)), F.lit(0.0)) for i in _DIMS})
    rows = rows.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in _DIMS), F.lit(0.0)))
    return rows.withColumn("bin", F.floor(F.log1p("d2") * BINS).cast("int"))


def by_bin(members: DataFrame, estimate: DataFrame, *, sums: bool = True) -> DataFrame:
    """Per group and distance bin: count, sums and products, with the count of nearer
    rows (``before``) and of all (``total``). At most some thousand rows a group."""
    rows = measured(members.join(broadcast_if_small(estimate), "key"))
    added = [F.sum(f"y{i}").alias(f"s{i}") for i in _DIMS] + [F.sum(F.col(f"y{i}") * F.col(f"y{j}")).alias(f"s{i}{j}") for i, j in _ENTRIES]
    per = rows.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("n"), *(added if sums else []))
    nearer = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy("key")))


def estimated(bins: DataFrame, centres: DataFrame) -> DataFrame:
    """Means, and the inverse of the covariance's Cholesky factor, of the rows in ``bins``."""
    names = [f"s{i}" for i in _DIMS] + [f"s{i}{j}" for i, j in _ENTRIES]
    out = bins.groupBy("key").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])
    out = out.withColumns({f"mu{i}": F.col(f"s{i}") / F.col("n") for i in _DIMS})
    v = {(i, j): F.col(f"s{i}{j}") / F.col("n") - F.col(f"mu{i}") * F.col(f"mu{j}") for i, j in _ENTRIES}
    out = out.withColumns({f"v{i}{j}": e + FLOORS[i] ** 2 if i == j else e for (i, j), e in v.items()})
    for j in _DIMS:  # v = l l', column by column
        rest = {i: F.col(f"v{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0)) for i in range(j, DIM)}
        out = out.withColumn(f"l{j}{j}", F.sqrt(rest[j]))
        out = out.withColumns({f"l{i}{j}": rest[i] / F.col(f"l{j}{j}") for i in range(j + 1, DIM)})
    for i in _DIMS:  # m = inverse of l, row by row
        top = {j: F.lit(1.0) if i == j else -sum((F.col(f"l{i}{k}") * F.col(f"m{k}{j}") for k in range(j, i)), F.lit(0.0)) for j in range(i + 1)}
        out = out.withColumns({f"m{i}{j}": e / F.col(f"l{i}{i}") for j, e in top.items()})
    out = out.select("key", *[f"mu{i}" for i in _DIMS], *[f"m{i}{j}" for i, j in _ENTRIES])
    return centres.select("key", *[f"c{i}" for i in _DIMS]).join(out, "key")


def _scale(bins: DataFrame) -> DataFrame:
    """Per group the median squared distance over that of a normal sample, at least 1."""
    middle = bins.where("before < total / 2").groupBy("key").agg(F.max("bin").alias("middle"))
    return middle.select("key", F.greatest(F.lit(1.0), (F.exp((F.col("middle") + 0.5) / BINS) - 1) / CHI_MEDIAN).alias("factor"))


def estimates(members: DataFrame, *, steps: int = STEPS) -> DataFrame:
    """Per group the final estimate and the ``factor`` of its squared distances. Each
    step's table (one row per group) is written and read back."""
    spark = members.sparkSession
    now = centres = written(started(members), spark, "mcd-start")
    for step in range(steps):
        bins = by_bin(members, now)
        now = written(estimated(bins.where(F.col("before") < F.ceil(F.col("total") * SUBSET)), centres), spark, f"mcd-{step}")
    bins = written(by_bin(members, now), spark, "mcd-bins")
    near = bins.join(_scale(bins), "key").where((F.exp(F.col("bin") / BINS) - 1) / F.col("factor") <= REWEIGHT)
    now = written(estimated(near, centres), spark, "mcd-weighted")
    return written(now.join(_scale(by_bin(members, now, sums=False)), "key"), spark, "mcd")


def judge(docs: DataFrame, *, least: int = LEAST_ROWS, cut: float = CUT) -> DataFrame:
    """Per document: ``doc_id``, the base counts, ``base_failed``, ``kept`` and the scaled
    squared ``distance`` (null without an estimate)."""
    spark = docs.sparkSession
    rows = written(statistics(counted(docs)), spark, "text-statistics")
    route, members = routed(rows, least)
    members = _same_group(rows.where("not base_failed"), members)
    estimate = estimates(written(members.select("key", *[f"x{i}" for i in _DIMS]), spark, "mcd-members"))
    judged = _same_group(rows, route.withColumnRenamed("route", "key"), "left")
    judged = measured(judged.join(broadcast_if_small(estimate), "key", "left"))
    distance = F.col("d2") / F.col("factor")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.coalesce(distance <= cut, F.lit(True))).alias("kept"), distance.alias("distance"))
