"""Personal data: base patterns, and candidates judged by boosted trees.

Generators with high recall propose spans of four kinds, overlapping freely:
addresses written with "(at)" and "dot", numbers grouped like phone numbers
without a plus sign, card numbers with other separators, dotted quads with
brackets. A gradient-boosted model judges each by its format (digits, groups,
separators, check sum, octets) and its context (cue words before it, what it
touches); a span is added if its probability reaches its kind's
calibrated threshold.
Spans that match the base patterns always stay.

The model is trained on all candidates of all documents that hold two digits or
an ``@``, where they lie (:mod:`.boosting`). Base spans are positive and
so are rewritten forms of them; candidates that fail their kind's validator and
rewritten decoys are negative.

Defined cases: null text is empty and has no spans; spans are in code points,
end exclusive; of equal start and kind the shorter comes first; repeated rows
give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import doc_texts, slices, written

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.95
PRECISION = 0.98  # share of true spans asked of a calibrated threshold
LEAST_CALIBRATION = 50  # spans of a kind below which its threshold is not calibrated
SCORED = 4096  # candidates scored at once
FEATURES = 25

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match starts where a run of digits starts and takes whole runs, so it never has to back up
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 if d > "4" else 2 * int(d)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each ``@`` with the run of local-part characters before it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            last = match.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, sorted."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
        out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 14 <= len(d := _only_digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_only_digits(m[0])) <= 15]
    return sorted(out)


_SPELLED = re.compile(r"\(at\)|\[at\]|\{at\}| at |@", re.I)
_AT = rf" ?(?:{_SPELLED.pattern}) ?"
_DOT = r" ?(?:\(dot\)|\[dot\]|\{dot\}| dot |\.) ?"
_GENERATORS = (
    (0, re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}", re.I)),
    (1, re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\.|\[\.\]|\(\.\)) ?[0-9]{1,3}){3}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9]{4}(?:[ ._/-]{0,2}[0-9]{2,6}){2,4}(?![0-9])")),
    (3, re.compile(r"(?<![0-9+])(?:(?:00|\+)[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ ./-]{0,2}[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9])")),
)
_CUES = (re.compile(r"mail|contact|write|address", re.I), re.compile(r"\bip\b|host|server|addr", re.I),
         re.compile(r"card|visa|credit|master|payment|\bcc\b", re.I), re.compile(r"phone|tel|call|mobile|cell|fax|dial", re.I))
_SECRET = re.compile(r"password|token|secret|key|sha|uuid|id\s*[=:]", re.I)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) proposed by the generators; spans may overlap."""
    out = []
    digits = _DIGIT.search(text) is not None
    spelled = _SPELLED.search(text) is not None
    for kind, pattern in _GENERATORS:
        if digits if kind else spelled:
            out += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return out


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a span."""
    span, before, after = text[start:end], text[max(0, start - 32):start], text[end:end + 8]
    digits = _only_digits(span)
    groups = [len(g) for g in _DIGITS.findall(span)]
    others = {c for c in span if not c.isalnum()}
    numbers = [int(g) for g in _DIGITS.findall(span)][:8]
    tail = re.split(r"[^A-Za-z0-9-]+", span)[-1]
    spelled = re.search(r"(?:\(|\[|\{| )(?:at|dot)(?:\)|\]|\}| )", span, re.I)
    return [
        float(kind == 0), float(kind == 1), float(kind == 2), float(kind == 3), float(len(span)), float(len(digits)),
        float(sum(c.isalpha() for c in span)), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(len(others)), float(luhn(digits)) if 13 <= len(digits) <= 19 else -1.0,
        float(len(numbers) == 4 and max(numbers) <= 255), float("(" in span and ")" in span), float(groups[-3:] == [3, 3, 4]),
        float(len(set(groups)) == 1), float(tail.isalpha()) * len(tail), float(spelled is not None) + float("@" in span),
        float(bool(_CUES[kind].search(before))), float(bool(_SECRET.search(before))),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "$€£#=\""), float(after[:1] in "%\"=/"),
        float(span[:1] == "+" or before[-1:] == "+"),
    ]


def _rewritten(text: str, start: int, kind: int, end: int, draw: random.Random) -> list[tuple[str, int, int, int, int]]:
    """(text, start, kind, end, label): other spellings of a base span, and decoys, in its place."""
    span, head, tail = text[start:end], text[max(0, start - 40):start], text[end:end + 10]
    number = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    good, bad = [], []
    if kind == 0:
        name, _, host = span.partition("@")
        spell = draw.choice(((" at ", " dot "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", ".")))
        good = [name + spell[0] + host.replace(".", spell[1])]
        words = re.findall(r"[a-z]{3,8}", text[:400]) or ["one", "two"]
        bad = [f"{draw.choice(words)} at {draw.choice(words)}. {draw.choice(words)}", f"{draw.choice(words)} at {draw.choice(words)}.{draw.choice(words)} {draw.choice(words)}"]
    elif kind == 1:
        good = [span.replace(".", draw.choice(("[.]", "(.)")))]
        bad = [".".join(number(1) for _ in range(4)) + "." + number(1), ".".join(str(draw.randrange(256, 999)) for _ in range(4))]
    elif kind == 2:
        d = _only_digits(span)
        mark = draw.choice((".", "_", "  ", "/"))
        good = [mark.join(d[i:i + 4] for i in range(0, len(d), 4))]
        wrong = d[:-1] + str((int(d[-1]) + draw.randrange(1, 10)) % 10)
        bad = [mark.join(wrong[i:i + 4] for i in range(0, len(wrong), 4)), wrong, number(4) + "-" + number(2) + "-" + number(2)]
    else:
        d = _only_digits(span)[-10:]
        good = [draw.choice((f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"({d[:3]}) {d[3:6]} {d[6:]}"))]
        bad = [number(10), number(8), f"{number(4)}-{number(2)}-{number(2)}", f"{number(2)}.{number(2)}.{number(4)}", f"{number(3)} {number(3)} {number(3)}"]
    out = []
    for label, forms in ((1, good), (0, bad)):
        for form in forms:
            out.append((head + form + tail, len(head), kind, len(head) + len(form), label))
    return out


def examples(doc_id: int, text: str) -> Iterator[tuple[list[float], int]]:
    """Training rows of one document: of all its base spans and candidates."""
    draw = random.Random(doc_id)
    spans = base_spans(text)
    base = {(a, k) for a, k, _ in spans}
    found = [(a, k, b) for a, k, b in candidates(text) if (a, k) not in base]
    for a, k, b in spans:
        yield features(text, a, k, b), 1
        for t, x, kind, y, label in _rewritten(text, a, k, b, draw):
            yield features(t, x, kind, y), label
    known = Cover(spans)
    for a, k, b in found:
        if known.meets(a, b):
            continue  # part of a base span under another kind: says nothing
        yield features(text, a, k, b), 0


class Cover:
    """Disjoint stretches of a text, kept in order; overlaps are found by bisection."""

    def __init__(self, spans: list[tuple[int, int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, _, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)  # the stretches before this one begin before ``end``
        return at > 0 and self.ends[at - 1] > start

    def add(self, start: int, end: int) -> None:
        """A stretch that meets no other."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


@dataclass
class Finder:
    """A model and, per kind, the probability from which a candidate is a span."""

    model: boosting.Boosted
    thresholds: tuple[float, ...] = (THRESHOLD,) * len(KINDS)

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans and added ones, each sorted."""
        base = base_spans(text)
        known = Cover(base)
        found = sorted({c for c in candidates(text) if not known.meets(c[0], c[2])})
        likely = []
        for at in range(0, len(found), SCORED):
            part = found[at:at + SCORED]
            p = self.model.probability(np.array([features(text, *c) for c in part]))
            likely += [(-q, c) for q, c in zip(p.tolist(), part, strict=True) if q >= self.thresholds[c[1]]]
        added, taken = [], Cover()
        for _, c in sorted(likely):  # of overlapping additions the likeliest stays
            if not taken.meets(c[0], c[2]):
                taken.add(c[0], c[2])
                added.append(c)
        return base, sorted(added)


def calibrated(p: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, *, precision: float = PRECISION) -> float:
    """The smallest threshold from which on, at every higher one, the share of true spans among those
    that reach it is at least ``precision``; ``THRESHOLD`` where too few say so, never below a half. With
    ``n`` each ``p`` stands for so many spans, ``y`` of them true."""
    n = np.ones(len(p)) if n is None else n
    if n.sum() < LEAST_CALIBRATION:
        return THRESHOLD
    order = np.argsort(-p, kind="stable")
    share = np.cumsum(y[order]) / np.cumsum(n[order])
    last = np.append(p[order][1:] != p[order][:-1], True)  # equal probabilities stand or fall together
    good = np.flatnonzero((np.minimum.accumulate(np.where(last, share, 1.0)) >= precision) & last)
    return max(0.5, float(p[order][good[-1]])) if len(good) else 1.0


def train(docs: DataFrame) -> Finder:
    """The model, learned from the candidates of three quarters of all documents, and per kind a threshold
    calibrated on the other quarter."""
    texts = doc_texts(docs).where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9]{2}|@"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = enumerate(examples(doc, text.as_py()))
                while rows := list(islice(found, SCORED)):
                    part = [boosting.ASIDE if doc % 4 == 0 else boosting.CURVE if (doc // 4 + i) % 5 == 0 else boosting.FIT for i, _ in rows]
                    yield pa.RecordBatch.from_arrays([pa.array([x for _, (x, _) in rows], pa.list_(pa.float64())), pa.array([y for _, (_, y) in rows], pa.int32()),
                                                      pa.array(part, pa.int32())], names=["x", "y", "part"])

    rows = written(texts.mapInArrow(run, "x array<double>, y int, part int"), docs.sparkSession, "candidates")
    model, blocks = boosting.fit(rows, FEATURES)
    counts = boosting.odds_counts(blocks, model, FEATURES, len(KINDS))
    if counts is None:
        return Finder(model)
    p = 1 / (1 + np.exp(-boosting.ODDS[:-1]))
    return Finder(model, tuple(calibrated(p[n > 0], ones[n > 0], n[n > 0]) for n, ones in counts))


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, finder: Finder | None = None) -> DataFrame:
    """Per document: ``doc_id``, base counts, ``base_sha256`` and all ``spans``, with
    the number added by the model."""
    finder = finder or train(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts: list[list[int]] = []
            digests, spans, added = [], [], []
            for text in batch.column("text"):
                base, more = finder.spans(text.as_py())
                kinds = [k for _, k, _ in base]
                counts.append([kinds.count(k) for k in range(4)])
                digests.append(hashlib.sha256(_written(base).encode()).hexdigest())
                spans.append(_written(sorted(base + more)))
                added.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([c[k] for c in counts], pa.int64()) for k in range(4)],
                 pa.array(digests), pa.array(spans), pa.array(added, pa.int64())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    return doc_texts(docs).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets (spans may overlap)."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])
