"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period ``q`` that holds at least two
periods and cannot be extended. All documents of a batch are laid end to end
with words of their own between them, so no run crosses a border, and one set
of array operations serves them all.

Scales are dyadic. At scale ``t`` runs with a period in [3t, 6t) are found:

1. Every position gets the hash of the next ``t`` words; hashes double from scale
   to scale. Positions whose next ``t`` words have a period of at most ``t/3`` are
   left out: they lie in runs that smaller scales have found.
2. The synchronising set holds a position when the smallest hash of the ``t + 1``
   positions from it on is its own or that of the last of them. Membership rests
   on the next ``2t`` words alone, so equal contexts are chosen alike, and any
   ``t`` positions hold a member unless their words are highly periodic.
3. Members with the same ``2t`` words at a distance in [3t, 6t) propose a period.
   Equal contexts are more than ``t/3`` apart, so each member has at most 18 such
   partners: all are tried.
4. A run whose first period is highly periodic may hold no member. Its two first
   periods then lie in two neighbouring runs of one small period, whose phases
   fix the possible periods up to multiples of the small one; all are proposed.
5. Proposals are extended word by word in both directions. The words decide, so a
   hash can cost time but never a result.

Periods below three times the first scale are read off directly.

Defined cases: a null text has no words; empty texts have no runs; a null
doc_id is not rewritten; rows that repeat a doc_id are judged each by itself;
ties between longest runs go to the smallest start, then the smallest period;
an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import doc_texts, raw_texts, slices

FIRST_SCALE = 4
LEAST_LENGTH = 12
PARTNERS = 18
COMPARE = 64  # words compared first when a proposal is extended, then doubled
SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long")
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of True of ``least`` or more."""
    steps = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    starts, ends = steps[::2], steps[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def windows_least(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def extended(words: np.ndarray, low: int, high: int, q: int) -> tuple[int, int]:
    """The run of period ``q`` around ``low <= x < high``, where word x is known to
    equal word x + q (or low == high, where nothing is known): its start and end."""
    width = COMPARE
    while high + q < len(words):
        n = min(width, len(words) - q - high)
        differ = words[high:high + n] != words[high + q:high + q + n]
        at = int(differ.argmax())
        if differ[at]:
            high += at
            break
        high += n
        width *= 2
    width = COMPARE
    while low > 0:
        n = min(width, low)
        differ = (words[low - n:low] != words[low + q - n:low + q])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            low -= at
            break
        low -= n
        width *= 2
    return low, high + q


class Found:
    """Runs by their extent; of several periods the smallest stays."""

    def __init__(self) -> None:
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, q: int) -> None:
        if end - start >= 2 * q and self.period.get((start, end), q) >= q:
            self.period[start, end] = q

    def arrays(self) -> np.ndarray:
        """One row (start, end, period) per run, by start, then end."""
        return np.array(sorted((s, e, q) for (s, e), q in self.period.items()), np.int64).reshape(-1, 3)


def paired(members: np.ndarray, context: np.ndarray, t: int) -> Iterator[tuple[int, np.ndarray]]:
    """Distances in [3t, 6t) between members of equal context, with the first member
    of each such pair in rising order."""
    order = np.lexsort((members, context))
    at, same = members[order], context[order]
    firsts, gaps = [], []
    for lag in range(1, PARTNERS + 1):
        if lag >= len(at):
            break
        gap = at[lag:] - at[:-lag]
        near = (same[lag:] == same[:-lag]) & (gap < 6 * t)
        if not near.any():
            break
        near &= gap >= 3 * t
        firsts.append(at[:-lag][near])
        gaps.append(gap[near])
    if not firsts:
        return
    first, gap = np.concatenate(firsts), np.concatenate(gaps)
    order = np.lexsort((first, gap))
    first, gap = first[order], gap[order]
    cuts = np.flatnonzero(np.diff(gap)) + 1
    for a, b in pairwise([0, *cuts.tolist(), len(gap)]):
        if a < b:
            yield int(gap[a]), first[a:b]


class Neighbours:
    """Two adjoining runs of one small period ``p`` and the distances that bring
    the words of the first onto the second: ``first`` and every ``p`` more."""

    def __init__(self, words: np.ndarray, a: int, b: int, a2: int, b2: int, p: int):
        self.a, self.b, self.a2, self.b2, self.p = a, b, a2, b2, p
        self.first = -1
        root, space = words[b - 2 * p:b - p].tobytes(), words[a2:a2 + 2 * p].tobytes()
        at = space.find(root)
        while at >= 0 and at % words.itemsize:
            at = space.find(root, at + 1)
        if at >= 0:
            self.first = (a2 + at // words.itemsize - (b - 2 * p)) % p

    def distances(self, t: int) -> range:
        if self.first < 0:
            return range(0)
        most = min(self.b - self.a, self.b2 - self.a2, 6 * t - 1)
        return range(self.first + -(-(3 * t - self.first) // self.p) * self.p, most + 1, self.p)

    def run(self, words: np.ndarray, q: int) -> tuple[int, int] | None:
        low, high = max(self.a, self.a2 - q), min(self.b, self.b2 - q)
        return extended(words, low, high, q) if low < high else None


def all_runs(words: np.ndarray, longest: int) -> np.ndarray:
    """Every run of at least two periods in ``words`` whose period is at most
    ``longest // 2``: rows (start, end, period) by start, then end."""
    found = Found()
    n = len(words)
    most = min(longest, n) // 2
    for q in range(1, min(most, 3 * FIRST_SCALE - 1) + 1):
        for a, b in zip(*(x.tolist() for x in stretches(words[q:] == words[:-q], q)), strict=True):
            found.add(a, b + q, q)
    t = FIRST_SCALE
    if most < 3 * t:
        return found.arrays()
    hashes = mixed(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    span, small, pairs = 1, 0, []
    while most >= 3 * t:
        while span < t:
            hashes = mixed(hashes[:-span] * np.uint64(0x9E3779B97F4A7C15) + (hashes[span:] ^ (hashes[span:] << np.uint64(7))))
            span *= 2
        context = mixed(hashes[:-t] * np.uint64(0x9E3779B97F4A7C15) + (hashes[t:] ^ (hashes[t:] << np.uint64(7))))
        choice = hashes.copy()
        known = found.arrays()
        dense = known[(known[:, 2] <= t // 3) & (known[:, 1] - known[:, 0] >= t)]
        for a, b, _ in dense.tolist():
            choice[a:b - t + 1] = _NEVER
        # new pairs of neighbours: periods that are small at this scale for the first time
        rows = known[(known[:, 2] > small) & (known[:, 2] <= t // 3) & (known[:, 1] - known[:, 0] >= 9 * known[:, 2])]
        rows = rows[np.lexsort((rows[:, 0], rows[:, 2]))]
        for (a, b, p), (a2, b2, p2) in pairwise(rows.tolist()):
            if p == p2 and a2 <= b:
                pairs.append(Neighbours(words, a, b, a2, b2, p))
        small = t // 3
        least = windows_least(choice, t + 1)
        places = n - 2 * t + 1
        chosen = (least[:places] != _NEVER) & ((least[:places] == choice[:places]) | (least[:places] == choice[t:t + places]))
        members = np.flatnonzero(chosen)
        for q, firsts in paired(members, context[members], t):
            at = 0
            while at < len(firsts):
                start, end = extended(words, int(firsts[at]), int(firsts[at]), q)
                found.add(start, end, q)
                at += max(1, int(np.searchsorted(firsts[at:], end - q)))
        for pair in pairs:
            for q in pair.distances(t):
                run = pair.run(words, q)
                if run:
                    found.add(*run, q)
        t *= 2
    return found.arrays()


def rewritten(doc_id: int | None, words: list) -> list:
    """The words that are judged: every tenth document (by a checksum of its id) repeats
    a stretch of its own words from some place to its end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a:a + p] * times)[:n - a]


def _hex(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def described(words: list[bytes], runs: np.ndarray) -> tuple:
    """The result columns (after doc_id) of one document from its runs by (start, period)."""
    n = len(words)
    if not len(runs):
        return 0, None, None, None, None, _hex(b""), _hex(b" ".join(words)), n, n
    length = runs[:, 1] - runs[:, 0]
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in zip(runs[:, 0].tolist(), length.tolist(), runs[:, 2].tolist(), strict=True))
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    best = np.lexsort((runs[:, 2], runs[:, 0], -length))[0]
    k, q = int(length[best]), int(runs[best, 2])
    return (len(runs), int(runs[best, 0]), k, q, 1000 * k // q, _hex(lines.encode()),
            _hex(b" ".join([words[i] for i in kept.tolist()])), n, len(kept))


class Numbers(dict):
    """Words to numbers in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return len(self) - 1


def runs_of(texts: list[list[bytes]], least: int = LEAST_LENGTH) -> list[np.ndarray]:
    """Per document (a list of words) its runs of at least ``least`` words: rows (start,
    end, period) by start, then period. Documents of like length go together."""
    out: list[np.ndarray] = [np.empty((0, 3), np.int64)] * len(texts)
    classes: dict[int, list[int]] = {}
    for i, words in enumerate(texts):
        if len(words) >= least:
            classes.setdefault(len(words).bit_length(), []).append(i)
    for group in classes.values():
        numbers = Numbers()
        sizes = np.array([len(texts[i]) for i in group])
        ends = np.cumsum(sizes + 1)
        line = np.full(int(ends[-1]), -1, np.int64)
        inside = np.ones(len(line), bool)
        inside[ends - 1] = False
        line[inside] = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts[i] for i in group)), np.int64, int(sizes.sum()))
        line[ends - 1] = len(numbers) + np.arange(len(group))  # a word of its own ends each document
        runs = all_runs(line, int(sizes.max()))
        runs = runs[runs[:, 1] - runs[:, 0] >= least]
        of = np.searchsorted(ends, runs[:, 0], side="right")
        cuts = np.searchsorted(of, np.arange(len(group) + 1))
        for j, i in enumerate(group):
            if cuts[j] < cuts[j + 1]:
                own = runs[cuts[j]:cuts[j + 1]] - [ends[j] - sizes[j] - 1, ends[j] - sizes[j] - 1, 0]
                out[i] = own[np.lexsort((own[:, 2], own[:, 0]))]
    return out


def detect(docs: DataFrame) -> DataFrame:
    """Per document its count of runs, the longest of them, digests of all runs and of
    the words left when each run is cut to its first period, and both word counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = [rewritten(i, raw.split()) for i, raw in zip(ids, raw_texts(batch), strict=True)]
            columns = zip(*map(described, texts, runs_of(texts)), strict=True)
            types = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, map(list, columns), types)],
                                             names=[f.split()[0] for f in SCHEMA.split(", ")])

    return doc_texts(docs).mapInArrow(run, SCHEMA)
