"""Token files of directly addressable codes.

A file set is a Parquet folder with one row per segment: some consecutive
documents in ascending doc_id order. The ids of a segment are split into bytes.
Level ``k`` holds byte ``k`` of every id that has one; a bitmap per level marks
the ids that go on, and a rank directory (ones before every 512 bits) gives
their place in the next level, so :func:`access` reads any id in a step per
level and decodes no block. Segments hold whole documents, up to about
``SEGMENT_TOKENS`` ids unless one document is longer.

Documents are dealt by ranges of doc_id and each range is encoded and written
by the task that sorts it. Global positions need one number per range and per
segment, summed in two levels after the write; texts and codes never meet in
one task.

Defined cases: null text is empty and gives the end id alone; a null doc_id
comes first; rows of one doc_id follow each other ordered by a hash of the
text; ids up to 32 bits; an empty table gives an empty file set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import doc_texts, slices

SEGMENT_TOKENS = 1 << 18
RANK_BITS = 512
SCHEMA = ("part int, seq int, n_tokens long, doc_ids array<bigint>, doc_tokens array<bigint>, "
          "levels array<binary>, bitmaps array<binary>, ranks array<binary>")
_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
                    *[(x, pa.list_(pa.binary())) for x in ("levels", "bitmaps", "ranks")]])


def compress(ids: np.ndarray) -> dict[str, list[bytes]]:
    """Levels, continuation bitmaps and rank directories of ``ids``."""
    out: dict[str, list[bytes]] = {"levels": [], "bitmaps": [], "ranks": []}
    rest = ids.astype(np.uint32)
    while True:
        out["levels"].append((rest & 0xFF).astype(np.uint8).tobytes())
        rest = rest >> 8
        on = rest > 0
        if not on.any():
            return out
        bits = np.packbits(on, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (RANK_BITS // 8)))
        ones = np.bitwise_count(bits).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint32)
        out["bitmaps"].append(bits.tobytes())
        out["ranks"].append((np.cumsum(ones, dtype=np.uint32) - ones).tobytes())
        rest = rest[on]


def decompress(levels: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a segment."""
    ids = np.frombuffer(levels[0], np.uint8).astype(np.uint32)
    at = np.arange(len(ids))
    for k, (level, bits) in enumerate(zip(levels[1:], bitmaps, strict=True), 1):
        on = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(at), bitorder="little").view(bool)
        at = at[on]
        ids[at] |= np.frombuffer(level, np.uint8).astype(np.uint32) << np.uint32(8 * k)
    return ids


def access(levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes], i: int) -> int:
    """Id number ``i`` of a segment, from one byte of each level it reaches."""
    value = levels[0][i]
    for k, bits in enumerate(bitmaps):
        if not bits[i >> 3] >> (i & 7) & 1:
            break
        block = i // RANK_BITS
        before = bits[block * RANK_BITS // 8:i >> 3]
        ones = int.from_bytes(before, "little").bit_count() + (bits[i >> 3] & (1 << (i & 7)) - 1).bit_count()
        i = int.from_bytes(ranks[k][4 * block:4 * block + 4], "little") + ones
        value |= levels[k + 1][i] << 8 * (k + 1)
    return value


def _encode(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .tokens import ID_BYTES, Encoder

        encoder, end = Encoder.of(vocabulary), end_id.to_bytes(ID_BYTES, "little")
        part, seq = TaskContext.get().partitionId(), 0
        ids, docs, sizes, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            codes = compress(np.frombuffer(b"".join(ids), "<u4"))
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "n_tokens": held, "doc_ids": docs,
                                                "doc_tokens": sizes, **codes}], schema=_ARROW)

        for batch in slices(batches):
            texts = batch.column("text")
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                data = encoder.encode(text.as_py()) + end
                n = len(data) // ID_BYTES
                if held and held + n > SEGMENT_TOKENS:
                    yield segment()
                    ids, docs, sizes, held, seq = [], [], [], 0, seq + 1
                ids.append(data)
                docs.append(doc)
                sizes.append(n)
                held += n
        if docs:
            yield segment()

    return run


def write(docs: DataFrame, path: str, *, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0) -> None:
    """Encode all texts and write the file set to ``path``, in ascending doc_id order."""
    dealt = doc_texts(docs).repartitionByRange("doc_id")
    dealt = dealt.withColumn("h", F.xxhash64("text")).sortWithinPartitions("doc_id", "h").drop("h")
    dealt.mapInArrow(_encode(vocabulary, end_id), SCHEMA).write.mode("overwrite").parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def starts(segs: DataFrame) -> DataFrame:
    """``part, seq, start``: ids before each segment of the whole file set."""
    sizes = segs.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per range
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inner = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(parts, "part").select(
        "part", "seq", (F.col("base") + F.col("inner")).alias("start"))


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            seg = batch.slice(row, 1).to_pylist()[0]
            ids = decompress(seg["levels"], seg["bitmaps"]).astype("<u4")
            ends = np.cumsum(seg["doc_tokens"])
            begins = ends - seg["doc_tokens"]
            crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            n = len(crcs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([seg["part"]] * n, pa.int32()), pa.array([seg["seq"]] * n, pa.int32()), pa.array(seg["doc_ids"], pa.int64()),
                 pa.array(begins, pa.int64()), pa.array(seg["doc_tokens"], pa.int64()), pa.array(crcs, pa.int64())],
                names=["part", "seq", "doc_id", "inner", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a file set: ``doc_id, start, n_tokens, ids_crc32``, read from the codes."""
    segs = segments(spark, path)
    docs = segs.select("part", "seq", "doc_ids", "doc_tokens", "levels", "bitmaps").mapInArrow(
        _decode, "part int, seq int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return docs.join(starts(segs), ["part", "seq"]).select(
        "doc_id", (F.col("start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, *, column: str = "position") -> DataFrame:
    """``position, token`` for global positions, by random access. Each position
    finds its segment by cells of ``SEGMENT_TOKENS`` ids, an equi-join."""
    segs = segments(spark, path)
    spans = segs.join(starts(segs), ["part", "seq"])
    cell = lambda c: F.floor(c / SEGMENT_TOKENS)
    spans = spans.withColumn("cell", F.explode(F.sequence(cell(F.col("start")), cell(F.col("start") + F.col("n_tokens") - 1))))
    wanted = positions.select(F.col(column).cast("long").alias("position")).distinct().withColumn("cell", cell(F.col("position")))
    found = spans.join(wanted, "cell").where("position >= start and position < start + n_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(x["position"], access(x["levels"], x["bitmaps"], x["ranks"], x["at"])) for x in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())],
                                             names=["position", "token"])

    return found.select("position", (F.col("position") - F.col("start")).alias("at"), "levels", "bitmaps", "ranks").mapInArrow(
        run, "position long, token long")
