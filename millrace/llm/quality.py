"""Quality scores from preference pairs (Bradley-Terry).

Every labelled-good document beats labelled-bad ones: P(a beats b) is the
logistic function of score(a) - score(b), the score being linear in features of
the text. The weights minimise the logistic loss over feature differences
(Newton steps with a ridge). A document is kept if its score reaches the
point among the training scores that separates the labels best; the published
score is a logistic curve through that threshold, so that it lies in 0..1 and
``score >= cut`` is the same decision.

All labelled documents that are not held out are learned from, each in at least
one pair and each good one in at least ``PAIRS_PER_GOOD``. Features are computed from
whole texts in one pass and written; means, Newton steps and the counts behind the
threshold are sums over them, task by task.

Defined cases: null and empty texts have all-zero counts and still get a score;
labels that are null, held out or without a document are not learned from;
without both labels every score is 0.5; repeated rows score alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, held_out, raw_texts, slices, written

MAX_PER_LABEL = 4000
PAIRS_PER_GOOD = 8
CUT = 0.3
RIDGE = 1e-3
BUCKET = 4096  # labelled documents that are paired with each other
LEAST_EACH = 64  # documents of each label in a bucket
BINS = 1 << 16  # of raw scores, for the threshold

_LETTERS = bytes(x for x in range(256) if chr(x).isascii() and chr(x).isalpha() or x >= 128)
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b".,;:!?'\"()-"
_SPACE = b" \t\n\v\f\r"
_MARKUP = b"<>{}[]|\\/=_~^`#&%*$@+"
_SPLIT_MARKED = re.compile(rb"[#&%*$<>{}|\\^~=!]{2,}(?:\s|\Z)")
FEATURES = 22


def features(raw: bytes) -> list[float]:
    """Shares and shapes of a text: repetition, symbols, case, lines, word lengths."""
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * (FEATURES - 1) + [1.0]
    left = lambda drop: (size - len(raw.translate(None, drop))) / size
    counts = Counter(words)
    most = counts.most_common(1)[0][1]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = sum(map(eq, words, words[1:])) / n
    second = sum(map(eq, words, words[2:])) / n
    lengths = np.fromiter(map(len, words), np.int64, n)
    distinct = len(counts) / n
    marked = len(_SPLIT_MARKED.findall(raw)) / n
    ends = sum(raw.count(x) for x in (b".", b"!", b"?")) / n
    lower_start = sum(1 for w in words if 97 <= w[0] <= 122) / n
    return [
        math.log1p(n) / 10, math.log1p(size / n), float(lengths.std()) / 10, float(lengths.max() > 40),
        distinct, math.log(len(counts)) / math.log(n + 1), repeats, math.sqrt(repeats), second,
        most / n, math.sqrt(most / n), marked, math.sqrt(marked), left(_LETTERS), left(_UPPER), left(_DIGITS),
        left(_MARKS), left(_MARKUP), len(lines) / n, 1 - len(set(lines)) / max(1, len(lines)), min(ends, 1.0) + lower_start, 0.0,
    ]


@dataclass
class Ranker:
    """A fitted score: ``slope * (weights . (x - mean) / scale - threshold)``, on a logistic curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float = 0.0
    slope: float = 0.0
    cut: float = CUT

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.slope:
            return np.full(len(x), 0.5)
        z = self.slope * (self.raw(x) - self.threshold) + math.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("of"), pa.array([features(r) for r in raw_texts(batch)], pa.list_(pa.float64()))],
            names=["doc_id", "of", "x"])


def featured(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, a hash ``of`` its text, and its features ``x``."""
    texts = doc_texts(docs)
    return texts.withColumn("of", F.xxhash64("text")).mapInArrow(_featured, "doc_id long, of long, x array<double>")


def majority(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id, label`` of all rows that are not held out; of conflicting labels the majority counts (ties as 0)."""
    ids = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[column].cast("int").alias("label"))
    ids = ids.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    return ids.groupBy("doc_id").agg((F.avg("label") > 0.5).cast("int").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most: int = MAX_PER_LABEL) -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` documents per label, the first by
    a hash of the id, none of them held out. The ids (bounded) are broadcast. Of
    conflicting labels of one doc_id the majority counts (ties as 0), of its texts
    the smallest."""
    ids = written(majority(labels, column), docs.sparkSession, "labels")
    order = F.xxhash64("doc_id")
    chosen = ids.where("label = 1").orderBy(order, "doc_id").limit(most).unionByName(
        ids.where("label = 0").orderBy(order, "doc_id").limit(most))
    return doc_texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")


def labelled_features(docs: DataFrame, labels: DataFrame, column: str, every: DataFrame) -> DataFrame:
    """``doc_id, label, x`` of every labelled document that is not held out, one row each; of different
    texts of one doc_id the smallest counts. ``every``: :func:`featured` rows of ``docs``."""
    spark, ids = docs.sparkSession, written(majority(labels, column), docs.sparkSession, "labels")
    rows = every.join(ids, "doc_id").groupBy("doc_id", "label").agg(F.first("x").alias("x"), F.min("of").alias("least"), F.max("of").alias("most"))
    rows = written(rows, spark, "labelled")
    torn = rows.where("least <> most").select("doc_id", "label")
    if torn.isEmpty():
        return rows.select("doc_id", "label", "x")
    least = doc_texts(docs).join(torn.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = rows.where("least = most").select("doc_id", "label", "x").unionByName(torn.join(featured(least).drop("of"), "doc_id"))
    return written(rows, spark, "labelled")


def pairs(rows: DataFrame, counts: tuple[int, int], ranker: Ranker, pairs_per_good: int = PAIRS_PER_GOOD, bucket: int = BUCKET) -> DataFrame:
    """Feature differences of pairs (good less bad), in which every row of ``rows`` takes part: per bucket
    of about ``bucket`` rows ``weight`` and, as float32, ``differences``.

    Rows are dealt to buckets by a hash of their id; a label with less than ``LEAST_EACH`` rows a bucket is
    dealt to several. Inside a bucket the good ones take the bad ones in turn, each at least
    ``pairs_per_good`` and so many that none is left out; each good one weighs the same."""
    n = max(1, -(-sum(counts) // bucket))
    copies = [min(n, -(-LEAST_EACH * n // c)) for c in counts]
    first = F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")
    turns = F.sequence(F.lit(0), F.when(F.col("label") == 1, copies[1]).otherwise(copies[0]) - 1)
    dealt = rows.select("doc_id", "label", "x", F.explode(turns).alias("turn")).select("doc_id", "label", "x", F.pmod(first + F.col("turn"), F.lit(n)).alias("bucket"))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("doc_id")
        label = group.column("label").to_numpy()
        z = ranker.standard(np.array(group.column("x").to_pylist()).reshape(-1, FEATURES))
        good, bad = z[label == 1], z[label == 0]
        each = max(pairs_per_good, -(-len(bad) // max(1, len(good))))
        of = np.repeat(np.arange(len(good)), each if len(bad) else 0)
        d = good[of] - bad[np.arange(len(of)) % len(bad)] if len(of) else np.empty((0, FEATURES))
        return pa.table({"weight": pa.array([1 / each]), "differences": pa.array([d.astype(np.float32).tobytes()], pa.binary())})

    return dealt.groupBy("bucket").applyInArrow(run, "weight double, differences binary")


def logistic(differences: DataFrame, ridge: float = RIDGE, steps: int = 30) -> np.ndarray:
    """Weights that minimise the mean of log(1 + exp(-w.d)) over all :func:`pairs` plus a ridge: Newton
    steps, each one pass in which every task sums up its own pairs."""
    w = np.zeros(FEATURES)
    for _ in range(steps):

        def run(batches: Iterator[pa.RecordBatch], w: np.ndarray = w) -> Iterator[pa.RecordBatch]:
            total = np.zeros((FEATURES + 1, FEATURES + 1))  # Hessian, gradient, weight
            for batch in batches:
                for weight, raw in zip(batch.column("weight").to_pylist(), batch.column("differences").to_pylist(), strict=True):
                    d = np.frombuffer(raw, np.float32).reshape(-1, FEATURES).astype(float)
                    p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
                    total[:-1, :-1] += weight * ((d * (p * (1 - p))[:, None]).T @ d)
                    total[-1, :-1] += weight * (d.T @ p)
                    total[-1, -1] += weight * len(d)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

        parts = sorted(bytes(r["total"]) for r in differences.mapInArrow(run, "total binary").collect())  # one small row per task
        total = np.sum([np.frombuffer(x).reshape(FEATURES + 1, FEATURES + 1) for x in parts], axis=0)
        size = max(total[-1, -1], 1e-9)
        step = np.linalg.solve(total[:-1, :-1] / size + ridge * np.eye(FEATURES), ridge * w - total[-1, :-1] / size)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def threshold(rows: DataFrame, ranker: Ranker, counts: tuple[int, int]) -> tuple[float, float]:
    """The raw score that separates the labels of all ``rows`` best (sum of both labels' shares on their side;
    the middle of equally good ones), by counts in ``BINS`` equal bins, and the standard deviation of the scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = ranker.raw(np.array(batch.column("x").to_pylist()).reshape(-1, FEATURES))
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(raw)], names=["label", "raw"])

    raw = rows.select("label", "x").mapInArrow(run, "label int, raw double")
    low, high, spread = raw.agg(F.min("raw"), F.max("raw"), F.stddev_pop("raw")).first()
    at = F.least(F.lit(BINS - 1), F.floor((F.col("raw") - low) / ((high - low) / BINS or 1.0))).alias("bin")
    bins = raw.groupBy(at).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good"), F.min("raw").alias("low"),
                               F.max("raw").alias("high")).orderBy("bin").toPandas()  # at most BINS rows
    good, bad = bins["good"].to_numpy(), (bins["n"] - bins["good"]).to_numpy()
    balanced = np.cumsum(good[::-1])[::-1] / counts[1] + (np.cumsum(bad) - bad) / counts[0]
    best = np.flatnonzero(balanced >= balanced.max() - 1e-12)
    k = int(best[len(best) // 2])
    return (float((bins["low"][k] + bins["high"][k - 1]) / 2) if k else float(bins["low"][k])), float(spread)


def train(docs: DataFrame, labels: DataFrame, *, column: str = "quality", cut: float = CUT, every: DataFrame | None = None) -> Ranker:
    """Learn from all labelled documents that are not held out. ``every``: their features, if they are at hand."""
    rows = labelled_features(docs, labels, column, featured(docs) if every is None else every)
    of = [F.get("x", F.lit(i)) for i in range(FEATURES)]
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("good"), *[F.avg(c) for c in of], *[F.stddev_pop(c) for c in of]).first()
    counts = (sums["n"] - sums["good"], sums["good"])
    if not min(counts):
        return Ranker(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), cut=cut)
    out = Ranker(np.array(sums[2:2 + FEATURES]), np.maximum(np.array(sums[2 + FEATURES:]), 1e-6), np.zeros(FEATURES), cut=cut)
    out.weights = logistic(written(pairs(rows, counts, out), docs.sparkSession, "pairs"))
    out.threshold, spread = threshold(rows, out, counts)
    out.slope = 4 / max(spread, 1e-9)
    return out


def score(rows: DataFrame, ranker: Ranker) -> DataFrame:
    """Per row of :func:`featured`: ``doc_id, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist()).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ranker.score(x))], names=["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``."""
    every = written(featured(docs), docs.sparkSession, "features")  # texts are read once, for learning and scoring
    ranker = train(docs, labels, every=every, **options)
    out = score(every, ranker)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= ranker.cut).cast("int").alias("predicted"))
