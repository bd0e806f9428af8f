"""Approximate nearest neighbours by collision counting.

Every vector is projected on ``PROJECTIONS`` random directions; an index block
keeps one sorted array per direction. A query opens a window around its own
projection in each array and widens all of them step by step (virtual rehashing:
no array is built anew). A vector that lies inside at least ``SHARE`` of the
windows is verified by its exact distance. Widening stops when the nearest
found lie within the radius that the windows stand for, or when a part
``VERIFY`` of the block has been verified; whatever crosses the threshold in one
step is verified in full, however many there are.

The index is cut into blocks of about ``BLOCK`` rows and the queries into blocks
of ``QUERIES``; each pair of blocks is one bounded group, and the best of all
blocks are merged per query. Nothing is collected or broadcast.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, neither as query nor as candidate; rows that repeat a
vec_id count once (the smallest vector); only vectors of the query's length are
candidates; equal distances go to the smaller vec_id; fewer candidates than
asked for are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

PROJECTIONS = 192
SHARE = 0.6
VERIFY = 0.08
WIDEN = 1.2
BLOCK = 8192
QUERIES = 512
SEED = 20240229


class CollisionIndex:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, *, projections: int = PROJECTIONS, share: float = SHARE, verify: float = VERIFY):
        self.ids, self.vectors = ids, vectors
        self.directions = np.random.default_rng(SEED).standard_normal((projections, vectors.shape[1]))
        shadows = np.ascontiguousarray((vectors @ self.directions.T).T)
        order = np.argsort(shadows, axis=1, kind="stable")
        self.order = order.astype(np.int32)
        shadows = np.take_along_axis(shadows, order, axis=1)
        # all arrays in one, each moved past the one before: a step is two searches
        self.shift = 4 * (1 + float(np.abs(shadows).max(initial=0.0))) * np.arange(projections)
        self.sorted = (shadows + self.shift[:, None]).ravel()
        self.threshold = int(np.ceil(share * projections))
        self.verify = verify
        # windows start where a few vectors would cross the threshold
        spread = float(np.median(shadows[:, -1] - shadows[:, 0])) if len(ids) else 1.0
        self.start = max(spread / 32, 1e-12)

    def nearest(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[float, int]]:
        """(distance, id) of the ``k`` nearest found, without the query's own id."""
        n = len(self.ids)
        reach = self.shift[1] / 4 if len(self.shift) > 1 else np.inf
        at = np.clip(self.directions @ query, -reach, reach) + self.shift
        first = np.arange(len(self.shift)) * n
        counts = np.zeros(n, np.int32)
        low = np.searchsorted(self.sorted, at) - first
        high = low.copy()
        known = np.zeros(n, bool)
        best, names = np.empty(0), np.empty(0, self.ids.dtype)
        width, enough = self.start, k + 1 + int(self.verify * n)
        while True:
            wide = min(width, reach)
            new_low = np.searchsorted(self.sorted, at - wide, "left") - first
            new_high = np.searchsorted(self.sorted, at + wide, "right") - first
            if wide >= reach:  # the window holds the whole array
                new_low[:], new_high[:] = 0, n
            fresh = [o[a:b] for o, a, b in zip(self.order, new_low, low, strict=True) if a < b]
            fresh += [o[a:b] for o, a, b in zip(self.order, high, new_high, strict=True) if a < b]
            low, high = new_low, new_high
            if fresh:
                counts += np.bincount(np.concatenate(fresh), minlength=n).astype(np.int32)
            over = np.flatnonzero((counts >= self.threshold) & ~known)
            if len(over):
                known[over] = True
                over = over[self.ids[over] != query_id]
                gap = np.concatenate([best, np.sqrt(((self.vectors[over] - query) ** 2).sum(axis=1))])
                name = np.concatenate([names, self.ids[over]])
                first_k = np.lexsort((name, gap))[:k]
                best, names = gap[first_k], name[first_k]
            done = len(best) == k and best[-1] < width / 2
            if done or known.sum() >= enough or (low == 0).all() and (high == n).all():
                return list(zip(best.tolist(), names.tolist(), strict=True))
            width *= WIDEN


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the vectors that take part, one row per id."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].alias("embedding"))
    rows = rows.where("vec_id is not null and embedding is not null and size(embedding) > 0").withColumn("v", v)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def _search(k: int, options: dict):
    def run(group: pa.Table) -> pa.Table:
        asked = np.array(group.column("asked").to_pylist(), bool)
        ids = group.column("vec_id").to_numpy()
        vectors = np.asarray(group.column("v").combine_chunks().flatten()).reshape(len(ids), -1)
        order = np.argsort(ids[~asked], kind="stable")
        index = CollisionIndex(ids[~asked][order], vectors[~asked][order], **options)
        rows = [(q, i, d) for q, x in zip(ids[asked].tolist(), vectors[asked], strict=True) for d, i in index.nearest(q, x, k)] if len(order) else []
        return pa.table({"query_id": pa.array([r[0] for r in rows], pa.int64()), "vec_id": pa.array([r[1] for r in rows], pa.int64()),
                         "score": pa.array([r[2] for r in rows], pa.float64())})

    return run


def search(vectors: DataFrame, *, k: int = 10, is_query=None, block: int = BLOCK, queries: int = QUERIES, **options) -> DataFrame:
    """The ``k`` nearest found of each query row (``is_query``: a condition on vec_id,
    by default ids divisible by 100): ``query_id, rank, vec_id, score``."""
    spark = vectors.sparkSession
    rows = written(usable(vectors), spark, "vectors")
    wanted = is_query if is_query is not None else F.col("vec_id") % 100 == 0
    sizes = {r["dim"]: (r["n"], r["q"]) for r in rows.groupBy("dim").agg(  # one row per vector length
        F.count(F.lit(1)).alias("n"), F.sum(wanted.cast("long")).alias("q")).collect()}
    blocks = {d: (-(-n // block), -(-q // queries)) for d, (n, q) in sizes.items() if q}
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    parts = spark.createDataFrame([(d, a, b) for d, (a, b) in blocks.items()], "dim int, blocks int, query_blocks int")
    placed = rows.join(F.broadcast(parts), "dim").withColumn("h", F.xxhash64("vec_id"))
    stored = placed.withColumn("block", F.pmod("h", "blocks")).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    asked = placed.where(wanted).withColumn("query_block", F.pmod("h", "query_blocks").cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    columns = ["dim", "block", "query_block", "vec_id", "v"]
    both = stored.select(*columns, F.lit(False).alias("asked")).unionByName(asked.select(*columns, F.lit(True).alias("asked")))
    near = both.groupBy("dim", "block", "query_block").applyInArrow(_search(k, options), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
