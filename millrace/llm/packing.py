"""Hierarchical packing into windows of several lengths.

Each task packs the documents of its own partition in one pass: nothing is
shuffled. A document gives full windows of the longest length first; what
remains is routed to the shortest tier that holds it. A window of a tier takes
one document of the tier, then its gap is filled with whole documents of the
shorter tiers, longest first, and the last piece is cut so that the window is
full. Full windows need no padding, whatever their tier. What is left when a
partition ends is laid out in windows of falling powers of two, again without
padding. Sequences of one tier make step groups of equal token counts.

Sequence ids are ``partition * 2**32 + n``: unique, and the same when a lost
task runs again on the same split.

Defined cases: null text is empty and gives the end id alone; repeated rows
are packed as often as they come; a text longer than a window is cut; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import doc_texts, slices

TIERS = (256, 512, 1024, 2048, 4096)
STEP_TOKENS = 8 * 4096
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, tier int, step long")
_ARROW = pa.schema([(c, pa.int32() if c == "tier" else pa.int64())
                    for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step")])
_ID = 4


class Packer:
    """Packs documents as they come. A piece is (doc_id, ids, start, tokens of the document)."""

    def __init__(self, first_sequence: int, tiers=TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = tuple(sorted(tiers)), step_tokens
        self.pools: dict[int, deque] = {t: deque() for t in self.tiers}
        self.held = dict.fromkeys(self.tiers, 0)  # tokens waiting in each tier
        self.first, self.sequence = first_sequence, first_sequence
        self.in_tier: dict[int, int] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        total, top, start = len(ids) // _ID, self.tiers[-1], 0
        while total - start >= top:
            self._seal(top, [(doc_id, ids[start * _ID:(start + top) * _ID], start, total)])
            start += top
        if start < total:
            self._wait((doc_id, ids[start * _ID:], start, total))
        for tier in reversed(self.tiers):
            while self.pools[tier] and self._below(tier) >= tier:
                self._window(tier)

    def _wait(self, piece: tuple) -> None:
        n = len(piece[1]) // _ID
        tier = next(t for t in self.tiers if n <= t)
        self.pools[tier].append(piece)
        self.held[tier] += n

    def _below(self, tier: int) -> int:
        return sum(n for t, n in self.held.items() if t <= tier)

    def _take(self, tier: int) -> tuple:
        piece = self.pools[tier].popleft()
        self.held[tier] -= len(piece[1]) // _ID
        return piece

    def _fit(self, tier: int, room: int, window: list) -> int:
        """Put the first document of ``tier`` into the window, cut if it is longer."""
        doc_id, ids, start, total = self._take(tier)
        n = len(ids) // _ID
        if n > room:
            self._wait((doc_id, ids[room * _ID:], start + room, total))
            n, ids = room, ids[:room * _ID]
        window.append((doc_id, ids, start, total))
        return room - n

    def _window(self, tier: int) -> None:
        window: list = []
        room = self._fit(tier, tier, window)
        for t in reversed([t for t in self.tiers if t < tier]):  # whole documents, longest first
            while room and self.pools[t] and len(self.pools[t][0][1]) // _ID <= room:
                room = self._fit(t, room, window)
        while room:  # then one cut piece (two, if it ends before the gap does)
            room = self._fit(next(t for t in self.tiers if t <= tier and self.pools[t]), room, window)
        self._seal(tier, window)

    def _seal(self, tier: int, window: list) -> None:
        n = self.in_tier.get(tier, 0)
        self.in_tier[tier] = n + 1
        step = self.first + tier * (1 << 18) + n // max(1, self.step_tokens // tier)
        offset = 0
        for doc_id, ids, start, total in window:
            length = len(ids) // _ID
            self.rows.append((doc_id, start, length, zlib.crc32(ids), total, self.sequence, offset, tier, step))
            offset += length
        self.sequence += 1

    def finish(self) -> None:
        """Lay out what still waits, in windows of falling powers of two."""
        while left := self._below(self.tiers[-1]):
            room = min(self.tiers[-1], 1 << left.bit_length() - 1)
            window: list = []
            length = room
            for t in reversed(self.tiers):
                while room and self.pools[t]:
                    room = self._fit(t, room, window)
            self._seal(length, window)

    def drain(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(_ARROW)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def pack(docs: DataFrame, *, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, tiers=TIERS,
         step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``, and the ``tier`` and ``step`` group of its sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .tokens import Encoder

        encoder, end = Encoder.of(vocabulary, again=True), end_id.to_bytes(_ID, "little")
        packer = Packer(TaskContext.get().partitionId() << 32, tiers, step_tokens)
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                packer.add(doc_id, encoder.encode(text.as_py()) + end)
            yield packer.drain()
        packer.finish()
        yield packer.drain()

    return doc_texts(docs).mapInArrow(run, SCHEMA)
