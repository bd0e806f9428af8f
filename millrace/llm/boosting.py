"""Gradient-boosted trees for binary labels. Every row is learned from where it lies: tasks add up
histograms of gradients over binned features, the driver only chooses splits from their sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CUTS = 64  # of a feature, at most
FIT, CURVE, ASIDE = 0, 1, 2  # parts of the rows: for the trees, for the curve, for the caller
ODDS = np.linspace(-30, 30, 4097)  # edges of bins of log odds


@dataclass
class Node:
    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None
    at: int = 0  # the cut's number: bins up to it go left
    place: int = 0  # of an open leaf among those of its level

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.left is None:
            return np.full(len(x), self.value)
        out, low = np.empty(len(x)), x[:, self.feature] <= self.cut
        out[low], out[~low] = self.left.predict(x[low]), self.right.predict(x[~low])
        return out

    def of_bins(self, bins: np.ndarray, what: str = "value") -> np.ndarray:
        """:meth:`predict` (or the places of the leaves) for binned rows."""
        if self.left is None:
            return np.full(len(bins), getattr(self, what), float)
        out, low = np.empty(len(bins)), bins[:, self.feature] <= self.at
        out[low], out[~low] = self.left.of_bins(bins[low], what), self.right.of_bins(bins[~low], what)
        return out


@dataclass
class Boosted:
    """Additive trees on the log odds; ``curve`` calibrates their sum on a held-out part."""

    base: float = 0.0
    rate: float = 0.2
    trees: list[Node] = field(default_factory=list)
    curve: tuple[float, float] = (1.0, 0.0)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += self.rate * tree.predict(x)
        return out

    def binned_margin(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for tree in self.trees:
            out += self.rate * tree.of_bins(bins)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * self.margin(x) + b, -30, 30)))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def edges(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Per feature its cuts: the middles between neighbouring values, ``CUTS`` quantiles of them where there are more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [np.unique(column) for column in _matrix(batch).T]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width, dtype=np.int32), [len(v) for v in found])),
                                                  pa.array(np.concatenate(found))], names=["f", "v"])

    values = rows.where(F.col("part") == FIT).select("x").mapInArrow(run, "f int, v double").distinct()
    order = Window.partitionBy("f").orderBy("v")
    middle = values.select("f", ((F.col("v") + F.lead("v").over(order)) / 2).alias("m"), F.row_number().over(order).alias("i")).where("m is not null")
    steps = F.array(*[F.lit(float(q)) for q in np.linspace(0, 1, CUTS)])
    per = middle.groupBy("f").agg(F.count("m").alias("n"), F.percentile("m", steps).alias("some"), F.collect_list(F.when(F.col("i") <= CUTS, F.col("m"))).alias("all"))
    found = {r["f"]: np.unique(r["all"] if r["n"] <= CUTS else r["some"]) for r in per.collect()}  # at most CUTS a feature
    return [found.get(f, np.empty(0)) for f in range(width)]


def binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Per batch of rows their bins, labels and parts, a byte each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                bins = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (
                    bins, *(batch.column(c).to_numpy().astype(np.uint8) for c in ("y", "part")))], names=["bins", "y", "part"])

    return rows.select("x", "y", "part").mapInArrow(run, "bins binary, y binary, part binary")


def total(blocks: DataFrame, width: int, part: int, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``of(bins, labels)`` (an array of fixed size) over all rows of a part; None without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for bins, y, parts in zip(*(batch.column(c).to_pylist() for c in ("bins", "y", "part")), strict=True):
                here = np.frombuffer(parts, np.uint8) == part
                if here.any():
                    found = of(np.frombuffer(bins, np.uint8).reshape(-1, width)[here], np.frombuffer(y, np.uint8)[here].astype(float))
                    own = found if own is None else own + found
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.asarray(own, float).tobytes()], pa.binary())], names=["sum"])

    sums = sorted(bytes(r["sum"]) for r in blocks.mapInArrow(run, "sum binary").collect())  # one array of fixed size per task
    return np.sum([np.frombuffer(s) for s in sums], axis=0) if sums else None


def _grow(blocks: DataFrame, model: Boosted, cuts: list[np.ndarray], depth: int, ridge: float, least: float) -> Node:
    """One tree, level by level: a pass for each level."""
    width, size = len(cuts), CUTS + 1
    root = Node()
    level = [root]
    for d in range(depth):
        for i, node in enumerate(level):
            node.place = i

        def histogram(bins: np.ndarray, y: np.ndarray, m: int = len(level)) -> np.ndarray:
            p = 1 / (1 + np.exp(-np.clip(model.binned_margin(bins), -500, 500)))
            place = root.of_bins(bins, "place").astype(int)
            open_ = place >= 0
            at = ((place[open_, None] * width + np.arange(width)) * size + bins[open_]).ravel()
            return np.concatenate([np.bincount(at, np.repeat(v[open_], width), m * width * size) for v in (p - y, np.maximum(p * (1 - p), 1e-6))])

        sums = total(blocks, width, FIT, histogram).reshape(2, len(level), width, size)
        after = []
        for i, node in enumerate(level):
            node.place = -1
            g, h = sums[0, i, 0].sum(), sums[1, i, 0].sum()
            best = 1e-6
            if not d:
                node.value = -g / (h + ridge)
            if h <= 2 * least:
                continue
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                gl, hl = (np.cumsum(sums[k, i, f])[:len(c)] for k in (0, 1))
                gain = gl**2 / (hl + ridge) + (g - gl)**2 / (h - hl + ridge) - g**2 / (h + ridge)
                gain[(hl < least) | (h - hl < least)] = 0
                at = int(gain.argmax())
                if gain[at] > best:
                    best, node.feature, node.cut, node.at = gain[at], f, float(c[at]), at
                    values = -gl[at] / (hl[at] + ridge), -(g - gl[at]) / (h - hl[at] + ridge)
            if node.feature >= 0:
                node.left, node.right = (Node(value=float(v)) for v in values)
                after += [node.left, node.right]
        if not after:
            break
        level = after
    return root


def fit(rows: DataFrame, width: int, *, trees: int = 40, depth: int = 3, rate: float = 0.2, ridge: float = 1.0, least: float = 1.0) -> tuple[Boosted, DataFrame]:
    """Fit on all ``rows`` (``x array<double>, y int, part int``) of part ``FIT``, the curve on those of part
    ``CURVE``. Also returns the :func:`binned` rows."""
    out = Boosted(rate=rate)
    cuts = edges(rows, width)
    blocks = written(binned(rows, cuts), rows.sparkSession, "binned")
    counts = total(blocks, width, FIT, lambda _, y: np.array([len(y), y.sum()]))
    n, ones = counts if counts is not None else (0, 0)
    if n < 16 or ones in (0, n):
        out.base = 30.0 if ones else -30.0
        return out, blocks
    share = min(max(ones / n, 1e-3), 1 - 1e-3)
    out.base = float(np.log(share / (1 - share)))
    for _ in range(trees):
        out.trees.append(_grow(blocks, out, cuts, depth, ridge, least))
    a, b = 1.0, 0.0
    for _ in range(30):  # Platt's curve, held near the identity by a small ridge

        def sums(bins: np.ndarray, y: np.ndarray, a: float = a, b: float = b) -> np.ndarray:
            m = out.binned_margin(bins)
            p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
            w = p * (1 - p)
            return np.array([((p - y) * m).sum(), (p - y).sum(), (w * m * m).sum(), (w * m).sum(), w.sum()])

        found = total(blocks, width, CURVE, sums)
        if found is None:
            break
        gradient = np.array([found[0] + (a - 1), found[1] + b])
        step = np.linalg.solve(np.array([[found[2] + 1, found[3]], [found[3], found[4] + 1]]), gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    out.curve = (float(max(a, 0.05)), float(b))
    return out, blocks


def odds_counts(blocks: DataFrame, model: Boosted, width: int, kinds: int) -> np.ndarray | None:
    """Of the rows of part ``ASIDE``, per kind (the first features, one of which is not 0) and bin of the
    log odds (``ODDS``): how many there are, and how many are labelled 1."""
    size = len(ODDS) - 1

    def run(bins: np.ndarray, y: np.ndarray) -> np.ndarray:
        a, b = model.curve
        at = np.clip(np.searchsorted(ODDS, a * model.binned_margin(bins) + b, side="right") - 1, 0, size - 1)
        return np.concatenate([np.bincount(at[bins[:, k] > 0], v[bins[:, k] > 0], size) for k in range(kinds) for v in (np.ones(len(y)), y)])

    found = total(blocks, width, ASIDE, run)
    return None if found is None else found.reshape(kinds, 2, size)
