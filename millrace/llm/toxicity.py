"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are the first five letters of words, so inflected and compounded forms meet.
All terms of the labelled examples count. A term weighs
its sublinear frequency times its inverse document frequency among the examples,
times one plus its contrast: by how many standard errors its shares of toxic and
other examples differ. No term is cut; the contrast decides how near texts are that
share it. A query's length takes all its terms in, known or not.

The index is block-max: examples lie in blocks of ``BLOCK``, alike ones together;
frequent terms keep the largest weight they have in each block. A query's terms
bound the cosines of a whole block from above. The blocks of the highest bounds
are evaluated first, then those whose bound reaches the ``NEAREST``-th cosine found
there; the others are never read. These sums are in single precision, so every
example that could still be a neighbour by their largest error is computed again
in double precision: the neighbours found are exact.

Neighbours vote with the square of their cosine; a logistic curve fitted on
leave-one-out votes of the examples turns the vote into a probability.

Labels are learned from a bounded sample: at most ``MAX_PER_LABEL`` documents of
each label (the first by a hash of the id), and of these no more than hold
``SAMPLE_BYTES`` of text. Vocabulary and index are broadcast and grow with that
sample only.

Defined cases: null and empty texts, and texts without any known term, get the
share of toxic examples among those without a term; labels that are null,
held out or without a document are not learned from; of conflicting labels of one
doc_id the majority counts, ties as 0; without both labels every
score is the share of toxic labels (0.0 without any); ties between neighbours go
to the smaller doc_id; repeated rows score alike; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_texts, held_out, release_memory, slices, written
from .quality import labelled_sample

MAX_PER_LABEL = 5000
SAMPLE_BYTES = 256 << 20
NEAREST = 15
BLOCK = 64  # examples per block
BATCH = 128  # queries compared at once
LONG_LISTS = 1024  # terms whose lists are cut into blocks; decides the cost only
FIRST = 4  # blocks evaluated before the bounds are compared with what was found
MARGIN = 4e-4  # more than twice the relative error of a sum of weights (none is negative) in single precision
STEM = 5
CACHE_WORDS = 100_000
CUT = 0.5
_STRIP = ".,;:!?\"'()[]{}<>*#&%$-_~…«»“”"


def term_of(word: str) -> str:
    """The term of one word: its stem, empty where only marks are left."""
    return word.strip(_STRIP)[:STEM]


class Vocabulary:
    """Words to the numbers of their terms, -1 for none, through a bounded cache. Terms
    that the examples lack get numbers beyond the known ones."""

    def __init__(self, known: dict[str, int]):
        self.known, self.other, self.cache = known, {}, {}

    def number(self, word: str) -> int:
        term = term_of(word)
        if not term:
            out = -1
        elif (out := self.known.get(term, -1)) < 0:
            out = self.other.setdefault(term, len(self.known) + len(self.other))
        self.cache[word] = out
        return out

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a text in rising order, and how often each occurs."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
            self.other.clear()
        words = text.lower().split()
        found = np.fromiter(map(self.cache.get, words, repeat(-2)), np.int32, len(words))
        for i in np.flatnonzero(found == -2).tolist():
            found[i] = self.number(words[i])
        found.sort()
        first = np.flatnonzero(found[1:] != found[:-1]) + 1
        first = np.concatenate([[0], first]) if len(found) and found[0] >= 0 else first
        return found[first], np.diff(first, append=len(found))


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + size`` of all spans, end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def alike(vectors: np.ndarray) -> np.ndarray:
    """An order of the rows in which neighbours are alike: halves along the direction of
    largest spread, down to blocks."""
    out, todo = [], [np.arange(len(vectors))]
    while todo:
        rows = todo.pop()
        if len(rows) <= BLOCK:
            out.append(rows)
            continue
        x = vectors[rows] - vectors[rows].mean(axis=0)
        along = x @ np.linalg.eigh(x.T @ x)[1][:, -1]
        rows = rows[np.argsort(along, kind="stable")]
        half = -(-len(rows) // (2 * BLOCK)) * BLOCK
        todo += [rows[half:], rows[:half]]
    return np.concatenate(out) if out else np.empty(0, np.int64)


class BlockMaxIndex:
    """Exact nearest examples by cosine over sparse vectors of length 1 with no negative
    weight, laid end to end: example i holds terms ``cols[ends[i]:ends[i + 1]]``.

    Long lists (those of the ``LONG_LISTS`` most frequent terms) are cut into blocks, with
    the largest weight of each; short lists are read as they are. A block's bound is
    the sum of its long lists' maxima plus the largest sum that the short lists bring to
    one of its examples."""

    def __init__(self, n_terms: int, ends: np.ndarray, cols: np.ndarray, vals: np.ndarray):
        self.n = n = len(ends) - 1
        self.ends, self.cols, self.vals = ends, cols, vals
        owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(ends))
        sketch = np.zeros((n, 64))  # terms dealt to 64 signed places: enough to tell what is alike
        deal = np.random.default_rng(1).integers(0, 128, n_terms, dtype=np.int16)
        for a in range(0, len(cols), 1 << 18):  # in lots, so that building takes little more than the index
            part = slice(a, a + (1 << 18))
            dealt = deal[cols[part]]
            np.add.at(sketch, (owner[part], dealt >> 1), vals[part] * (1 - 2.0 * (dealt & 1)))
        self.order = alike(sketch)  # place -> example
        self.blocks = -(-n // BLOCK)
        self.place = np.empty(n, np.int32)
        self.place[self.order] = np.arange(n)
        often = np.bincount(cols, minlength=n_terms)
        long = np.argsort(-often, kind="stable")[:LONG_LISTS]
        self.lane = np.full(n_terms, -1, np.int32)
        self.lane[long] = np.arange(len(long))
        self.lists = np.zeros((self.blocks, len(long), BLOCK), np.float32)
        for a in range(0, len(cols), 1 << 18):
            part = slice(a, a + (1 << 18))
            lane, at = self.lane[cols[part]], self.place[owner[part]]
            listed = lane >= 0
            self.lists[at[listed] // BLOCK, lane[listed], at[listed] % BLOCK] = vals[part][listed]
        self.most = np.ascontiguousarray(self.lists.max(axis=2, initial=0).T)
        short = np.flatnonzero(self.lane[cols] < 0).astype(np.int32)
        short = short[np.argsort(cols[short], kind="stable")]
        self.at, self.weights = self.place[owner[short]], vals[short].astype(np.float32)
        often[long] = 0
        self.sizes, self.starts = often, np.cumsum(often) - often
        self.query = np.zeros(n_terms)
        self.evaluated = self.asked = 0  # blocks read, and queries: what the bounds save

    def _exact(self, which: np.ndarray, weights: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Cosines with some examples, in double precision."""
        self.query[which] = weights
        sizes = self.ends[of + 1] - self.ends[of]
        postings = spans(self.ends[of], sizes)
        out = np.bincount(np.repeat(np.arange(len(of)), sizes), self.query[self.cols[postings]] * self.vals[postings], len(of))
        self.query[which] = 0
        return np.round(out, 12)

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEAREST, skips: list[int] | None = None) -> list[list[tuple[int, float]]]:
        """Per query the ``k`` examples of largest cosine (above 0) but for one to skip, ties to the smaller number."""
        return [x for first in range(0, len(queries), BATCH) for x in self._batch(
            queries[first:first + BATCH], k, (skips or [-1] * len(queries))[first:first + BATCH])]

    def _batch(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, skips: list[int]) -> list[list[tuple[int, float]]]:
        m, width = len(queries), self.blocks * BLOCK
        left, short = np.zeros((m, len(self.most)), np.float32), np.zeros((m, width), np.float32)
        for i, (which, weights) in enumerate(queries):
            lane = self.lane[which]
            left[i, lane[lane >= 0]] = weights[lane >= 0]
            few, weights = which[lane < 0], weights[lane < 0]
            sizes = self.sizes[few]
            postings = spans(self.starts[few], sizes)
            short[i] = np.bincount(self.at[postings], np.repeat(weights, sizes) * self.weights[postings], width)
        bound = left @ self.most + short.reshape(m, self.blocks, BLOCK).max(axis=2, initial=0)
        score = np.full((m, width), -1, np.float32)
        first = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST]
        need = np.zeros((m, self.blocks), bool)
        np.put_along_axis(need, first, True, axis=1)
        skipped = np.array(skips)
        for turn in range(2):
            for b in np.flatnonzero(need.any(axis=0)).tolist():
                rows, here = np.flatnonzero(need[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
                score[rows, here] = left[rows] @ self.lists[b] + short[rows, here]
            score[skipped >= 0, self.place[skipped[skipped >= 0]]] = -1
            self.evaluated += int(need.sum())
            if not turn:  # all blocks whose bound reaches the k-th best of the first few
                best = np.take_along_axis(score.reshape(m, self.blocks, BLOCK), first[:, :, None], axis=1).reshape(m, -1)
                least = np.maximum(np.partition(best, -k, axis=1)[:, -k], 0) * (1 - MARGIN) if best.shape[1] >= k else np.zeros(m)
                need = (bound > 0) & (bound * (1 + MARGIN) >= least[:, None]) & ~need
        self.asked += m
        out = []
        for i, (which, weights) in enumerate(queries):
            hits = np.flatnonzero((score[i] > 0) & (score[i] >= least[i]))
            if len(hits) > k:
                near = score[i, hits]
                hits = hits[near >= np.partition(near, -k)[-k] * (1 - MARGIN)]
            hits = self.order[hits]
            cosines = self._exact(which, weights, hits)
            best = np.lexsort((hits, -cosines))[:k]
            out.append([(int(hits[j]), float(cosines[j])) for j in best if cosines[j] > 0])
        return out

    def nearest(self, which: np.ndarray, weights: np.ndarray, k: int = NEAREST, skip: int = -1) -> list[tuple[int, float]]:
        """:meth:`nearest_of` for one query."""
        return self.nearest_of([(which, weights)], k, [skip])[0]


class Examples:
    """The labelled examples: their terms, and how often each example holds which. Sent
    packed; vocabulary and index are made where they are used."""

    def __init__(self, known: str, ends: np.ndarray, cols: np.ndarray, times: np.ndarray, labels: np.ndarray, names: np.ndarray):
        self.held = known, ends, cols, times, labels, names
        self.labels, self.names = labels, names
        self.words: Vocabulary | None = None

    def __getstate__(self) -> bytes:
        known, ends, cols, times, labels, names = self.held
        return zlib.compress(pickle.dumps((known, ends, np.diff(cols, prepend=np.int32(0)), times, labels, names)), 1)

    def __setstate__(self, packed: bytes) -> None:
        known, ends, steps, times, labels, names = pickle.loads(zlib.decompress(packed))
        self.__init__(known, ends, np.cumsum(steps, dtype=np.int32), times, labels, names)

    def build(self) -> None:
        if self.words is not None:
            return
        release_memory()
        known, ends, cols, times, labels, names = self.held
        self.held = ()
        numbers = numbered(known)
        self.weights = term_weights(len(numbers), ends, cols, labels)
        vals = np.empty(len(cols))
        for a in range(0, len(labels), 1024):  # in lots of examples, as the index is
            at = ends[a:a + 1025]
            part = slice(at[0], at[-1])
            lot = (np.log(times[part]) + 1) * self.weights[cols[part]]
            length = np.sqrt(np.add.reduceat(lot * lot, at[:-1] - at[0]))  # no example is without a term
            vals[part] = lot / np.repeat(length, np.diff(at))
        del times
        self.index = BlockMaxIndex(len(numbers), ends, cols, vals)
        self.place = {int(i): k for k, i in enumerate(names)}
        self.words = Vocabulary(numbers)
        release_memory()

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The known terms of a text and their weights; the length is that of all its terms."""
        which, times = self.words.counts(text)
        known = int(np.searchsorted(which, len(self.weights) - 1))  # the last weight is that of unknown terms
        weight = (1 + np.log(times)) * self.weights[np.minimum(which, len(self.weights) - 1)]
        return which[:known], weight[:known] / (math.sqrt(float(weight @ weight)) or 1.0)

    def votes(self, texts: list[str], ids: list[int] | None = None) -> Iterator[tuple[float | None, list[tuple[int, float]]]]:
        """Per text the share of toxic votes, None without a neighbour, and the neighbours;
        an example of the same id does not vote."""
        self.build()
        for first in range(0, len(texts), BATCH):
            skips = [self.place.get(i, -1) for i in ids[first:first + BATCH]] if ids is not None else None
            for near in self.index.nearest_of([self.vector(t) for t in texts[first:first + BATCH]], skips=skips):
                total = sum(c * c for _, c in near)
                yield sum(c * c * self.labels[j] for j, c in near) / total if total else None, [(int(self.names[j]), c) for j, c in near]


def term_weights(n_terms: int, ends: np.ndarray, cols: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Per term its inverse document frequency times one plus its contrast between the
    labels; the last one is for terms that no example holds."""
    n, toxic = len(ends) - 1, np.repeat(labels, np.diff(ends))
    df = np.bincount(cols, minlength=n_terms + 1)
    one = np.bincount(cols, toxic, n_terms + 1)
    ones, others = max(labels.sum(), 1), max(n - labels.sum(), 1)
    p, q = one / ones, (df - one) / others
    pooled = (p + q) / 2
    error = np.sqrt(np.maximum(pooled * (1 - pooled) * (1 / ones + 1 / others), 1e-12))
    return (np.log((n + 1) / (df + 1)) + 1) * (1 + np.abs(p - q) / error)


@dataclass
class Judge:
    """A fitted classifier: examples (a broadcast, bounded by the sample) and calibration."""

    examples: Broadcast | None
    prior: float
    curve: tuple[float, float] = (0.0, 0.0)

    def probability(self, vote: float | None) -> float:
        if vote is None:
            return self.prior
        a, b = self.curve
        return 1 / (1 + math.exp(-(a * vote + b)))

    def judge(self, texts: list[str]) -> list[tuple[float, list[tuple[int, float]]]]:
        if self.examples is None:
            return [(self.prior, []) for _ in texts]
        return [(self.probability(vote), near) for vote, near in self.examples.value.votes(texts)]


def numbered(known: str) -> dict[str, int]:
    """Terms, one a line, to their numbers."""
    return {t: i for i, t in enumerate(known.split("\n"))} if known else {}


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: the terms of its examples."""
    found: set[str] = set()
    for batch in slices(batches):
        words = {w for text in batch.column("text") for w in text.as_py().lower().split()}
        found.update(t for t in map(term_of, words) if t)
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string())], names=["term"])


def _vectors(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(numbered(shared.value))
        for batch in slices(batches):
            found = [words.counts(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([t for t, _ in found], pa.list_(pa.int32())),
                 pa.array([c for _, c in found], pa.list_(pa.int32()))], names=["doc_id", "label", "terms", "times"])

    return run


def _own_votes(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = list(shared.value.votes(batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([v for v, _ in found], pa.float64())], names=["doc_id", "vote"])

    return run


def _curve(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """A logistic curve through 0/1 labels over votes (weighted, with a small ridge)."""
    x = np.column_stack([votes, np.ones(len(votes))])
    w = np.array([4.0, -2.0])
    ridge = np.array([1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weights * (p - labels)) + ridge * (w - [4.0, -2.0])
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.1)), float(w[1])


def _sampled(docs: DataFrame, labels: DataFrame, column: str, most: int, most_bytes: int) -> DataFrame:
    """The labelled sample, cut (in the order of its hash) where its texts hold ``most_bytes``."""
    spark = docs.sparkSession
    sample = written(labelled_sample(docs, labels, column, most), spark, "examples")
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # at most 2 * most rows
    sizes = sample.select("doc_id", F.octet_length("text").alias("bytes")).withColumn("bytes", F.sum("bytes").over(so_far))
    beyond = [r["doc_id"] for r in sizes.where(F.col("bytes") > most_bytes).collect()]
    return sample.where(~F.col("doc_id").isin(beyond)) if beyond else sample


def train(docs: DataFrame, labels: DataFrame, *, column: str = "toxic", most: int = MAX_PER_LABEL, most_bytes: int = SAMPLE_BYTES) -> Judge:
    spark = docs.sparkSession
    sample = _sampled(docs, labels, column, most, most_bytes)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if not sizes.get(0) or not sizes.get(1):
        return Judge(None, share)
    found = sample.mapInArrow(_terms, "term string").distinct().toArrow()  # of the bounded sample
    known = "\n".join(sorted(found.column("term").to_pylist()))
    shared = spark.sparkContext.broadcast(known)
    rows = sample.mapInArrow(_vectors(shared), "doc_id long, label int, terms array<int>, times array<int>").toArrow()  # bounded
    shared.destroy()
    rows = rows.take(np.argsort(rows.column("doc_id").to_numpy(), kind="stable")).combine_chunks()
    # the sample's label shares are not the labels': weigh examples back
    true = {r["label"]: r["n"] for r in labels.where(~held_out(labels["doc_id"]) & labels[column].isin(0, 1)).groupBy(
        labels[column].cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    names, label = rows.column("doc_id").to_numpy(), rows.column("label").to_numpy().astype(float)
    weight = np.array([true.get(int(y), 1) / sizes[int(y)] for y in label])
    ends = np.append(0, np.cumsum(pc.list_value_length(rows.column("terms")).to_numpy()))
    empty = np.diff(ends) == 0
    prior = float((weight * label * empty).sum() + 0.01) / float((weight * empty).sum() + 1.0)
    cols, times = (pc.list_flatten(rows.column(c)).to_numpy() for c in ("terms", "times"))
    kept = np.flatnonzero(~empty)
    examples = spark.sparkContext.broadcast(Examples(known, np.append(0, ends[1:][kept]), cols, times, label[kept], names[kept]))
    votes = sample.mapInArrow(_own_votes(examples), "doc_id long, vote double").where("vote is not null").toArrow()
    own, first = np.unique(votes.column("doc_id").to_numpy(), return_index=True)
    at = np.searchsorted(names, own)
    return Judge(examples, prior, _curve(votes.column("vote").to_numpy()[first], label[at], weight[at]))


def score(docs: DataFrame, judge: Judge) -> DataFrame:
    """Per document: ``doc_id, score, neighbours, similarities`` (the evidence)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = judge.judge(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for s, _ in found], pa.float64()),
                 pa.array([[i for i, _ in near] for _, near in found], pa.list_(pa.int64())),
                 pa.array([[c for _, c in near] for _, near in found], pa.list_(pa.float64()))],
                names=["doc_id", "score", "neighbours", "similarities"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, score double, neighbours array<bigint>, similarities array<double>")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted`` and the evidence."""
    out = score(docs, train(docs, labels, **options))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= CUT).cast("int").alias("predicted"), "neighbours", "similarities")


def keep_clean(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that score below the cut, with all their columns; texts are
    judged where they lie, nothing is shuffled."""
    judge = train(docs, labels, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = judge.judge([t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array([p < CUT for p, _ in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
