"""Documents whose word shingles overlap by a Jaccard similarity of 0.75 or more.

A T-occurrence search over inverted lists of shingles, split as DivideSkip
splits it. A document with ``n`` shingles can only link with one that shares at
least ``T = ceil(0.75 n)`` of them, so its ``T - 1`` longest lists may be set
aside: every partner still occurs in one of the ``n - T + 1`` short ones.

How that becomes Spark jobs:

1. One pass over the texts gives each document its set size and set digest, and
   each task its most frequent shingles. Equal sets collapse to one
   representative, so copies cost nothing further.
2. The most frequent shingles of all tasks (``LONG_LISTS`` at most, a bounded
   broadcast) come last in the global order; the others follow their hash. Any
   order that all documents share gives the same result, so this bound decides
   the cost only. Each representative emits its first ``n - T + 1`` shingles;
   lists of one document vanish, the rest are the short lists.
3. Rounds: a list whose documents lie in one component is done. In each other
   list the document that meets most others in its lists is the pivot (in later
   rounds, outside the list's largest component); a document is checked against the pivot with which it shares most short lists, and
   components are contracted. A group of thousands of near copies costs a check
   per member and not one per pair.
4. All pairs of *different* components that still meet in a short list are
   searched if a link is possible: the sizes must allow it, and the number of short
   lists they share must reach what two linked documents share at least
   (:func:`_least_shared`). Documents with one pivot form a family, cut into blocks;
   a query is routed to blocks and not to single documents, so rows grow with the
   number of blocks met. Nothing is dropped: the components are exact.
5. Before whole sets move, the routed documents are screened by their
   :func:`sketch`, about a thirtieth of the set: it bounds the overlap of a pair from
   above, so only documents that cannot reach the needed overlap with any
   document of their group go.
6. A search runs :func:`divide_skip` on the inverted lists of one block of about
   ``BLOCK`` documents: short lists are merged by a heap, long ones probed by
   binary search.

Shingles are 64-bit hashes; sets are compared by them.

Defined cases: null and empty texts, and texts without words, have 0 shingles
and link with nothing (not even each other); fewer than five words are one
shingle; rows that repeat a doc_id are documents of their own, each linked by its
own text (inside, they go by ids above all others; ids must lie below 2**62);
rows with a null doc_id link with nothing and keep a null component; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .common import doc_texts, give_back, raw_texts, slices, written
from .components import connected

WORDS = 5
PERCENT = 75
#: Shingles that may be set aside as long lists: 8 bytes each in the broadcast.
LONG_LISTS = 1 << 18
#: Frequent shingles that a task reports, and how often it must have met them.
TASK_LISTS = 1 << 14
TASK_LEAST = 4
#: Shingles a task counts at once, and counts it keeps before it drops the rarer half.
TASK_WINDOW = 4_000_000
TASK_TABLE = 1 << 18
#: Candidates of one search; more of one query document go to further blocks.
BLOCK = 128
#: Rounds of pivots before the pairs that are left are searched.
PIVOT_ROUNDS = 1


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes. ``bytes.lower`` and
    ``bytes.split`` know exactly A-Z and the six white-space characters."""
    tokens = raw.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens))], np.uint64)
    digest = xxhash.xxh3_64_intdigest
    ids = np.array([digest(t) for t in tokens], np.uint64)
    n = len(ids) - words + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(words):  # an ordered combination of the five word hashes
        mixed = (mixed ^ ids[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """T: the overlap any partner of a set of ``n`` must reach."""
    return -(-n * percent // 100)


def sketch(s: np.ndarray) -> bytes:
    """How many shingles fall into each of 2^k >= n buckets (by the upper bits of the
    hash), four bits a bucket, deflated; empty if a bucket holds more than 15."""
    bits = max(1, (len(s) - 1).bit_length())
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    if counts.max(initial=0) > 15:
        return b""
    counts = counts.astype(np.uint8)
    return zlib.compress((counts[::2] << 4 | counts[1::2]).tobytes(), 1)


def buckets(packed: bytes) -> np.ndarray | None:
    """The bucket counts of a sketch, None of an empty one."""
    if not packed:
        return None
    pairs = np.frombuffer(zlib.decompress(packed), np.uint8)
    return np.stack([pairs >> 4, pairs & 15], axis=1).ravel()


def most_shared(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """No less than the number of shingles that two sets share: equal shingles fall
    into equal buckets. The finer counts are added up to the coarser ones."""
    if a is None or b is None:
        return np.inf
    if len(a) > len(b):
        a, b = b, a
    if len(b) > len(a):
        b = b.reshape(len(a), -1).sum(axis=1)
    return int(np.minimum(a, b).sum())


def divide_skip(lists: list[list[int]], least: int, long_lists: int) -> dict[int, int]:
    """Ids that occur in at least ``least`` of the sorted ``lists``, with their counts.

    The ``long_lists`` longest lists (fewer than ``least``) are set aside. The
    short ones are merged by a heap; an id that occurs there ``least - long_lists``
    times is looked for in the long ones by binary search, and given up when the
    lists that are left cannot bring it to ``least``."""
    order = sorted(lists, key=len)
    cut = len(order) - min(long_lists, least - 1)
    short, long = order[:cut], order[cut:]
    needed = least - len(long)
    found: dict[int, int] = {}
    heap = [(x[0], i, 0) for i, x in enumerate(short) if x]
    heapq.heapify(heap)
    while heap:
        top, count = heap[0][0], 0
        while heap and heap[0][0] == top:
            _, i, at = heap[0]
            count += 1
            if at + 1 < len(short[i]):
                heapq.heapreplace(heap, (short[i][at + 1], i, at + 1))
            else:
                heapq.heappop(heap)
        if count < needed:
            continue
        for k, x in enumerate(long):
            if count + len(long) - k < least:
                break
            at = bisect_left(x, top)
            count += at < len(x) and x[at] == top
        if count >= least:
            found[top] = count
    return found


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its set size, digest and sketch; at the end of the task its frequent shingles."""
    table = (np.empty(0, np.uint64), np.empty(0, np.int64))
    window: list[np.ndarray] = []
    held = 0

    def counted() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate(window)
        window.clear()  # the sets are many; one copy of them at a time
        every.sort()
        again = every[1:] == every[:-1]
        found, n = np.unique(every[1:][again], return_counts=True)
        n += 1
        del every, again
        both, at = np.unique(np.concatenate([table[0], found]), return_inverse=True)
        total = np.bincount(at, np.concatenate([table[1], n]), minlength=len(both)).astype(np.int64)
        if len(both) > TASK_TABLE:
            keep = np.sort(np.argsort(-total, kind="stable")[:TASK_TABLE // 2])
            both, total = both[keep], total[keep]
        return both, total

    def rows(ids, sizes, keys, sketches, found, counts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()),
             pa.array(found, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n", "key", "sketch", "shingle", "times"])

    for batch in slices(batches):
        sets = [shingles(raw) for raw in raw_texts(batch)]
        k = batch.num_rows
        yield rows(batch.column("doc_id").to_pylist(), [len(x) for x in sets],
                   [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], [sketch(x) if len(x) else None for x in sets],
                   [None] * k, [None] * k)
        window += sets
        held += sum(map(len, sets))
        if held > TASK_WINDOW:
            table, held = counted(), 0
    if window:
        table = counted()
        give_back()
    keep = np.argsort(-table[1], kind="stable")[:TASK_LISTS]
    keep = keep[table[1][keep] >= TASK_LEAST]
    k = len(keep)
    yield rows([None] * k, [None] * k, [None] * k, [None] * k, table[0][keep].view(np.int64), table[1][keep])


def _short_lists(frequent, percent: int):
    """(shingle, doc) for the first ``n - T + 1`` shingles of each document in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = frequent.value
        for batch in slices(batches):
            found, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for doc, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch), strict=True):
                s = shingles(raw)
                take = len(s) - least_overlap(len(s), percent) + 1 if len(s) else 0
                if len(known) and len(s):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    rank = np.where(known[at] == s, times[at], 0)
                    s = s[np.argsort(rank, kind="stable")]
                found.append(s[:take])
                owners.append(np.full(take, doc, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(owners))],
                                             names=["shingle", "doc"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([shingles(raw).tobytes() for raw in raw_texts(batch)], pa.binary())],
            names=["doc", "set"])


def _screen(percent: int):
    """The documents of one group that can link with one of the other side."""

    def run(group: pa.Table) -> pa.Table:
        counts: dict[bytes, np.ndarray | None] = {}
        asked, members = {}, {}
        for doc, query, n, packed in zip(*(group.column(c).to_pylist() for c in ("doc", "query", "n", "sketch")), strict=True):
            if packed not in counts:
                counts[packed] = buckets(packed)
            (asked if query else members)[doc, packed] = n
        queries, found = set(), set()
        for (q, mine), n in asked.items():
            for (doc, packed), m in members.items():
                if q == doc or min(n, m) * 100 < max(n, m) * percent or (q in queries and doc in found):
                    continue
                if most_shared(counts[mine], counts[packed]) * (100 + percent) >= (n + m) * percent:
                    queries.add(q)
                    found.add(doc)
        kept = [(d, True) for d in queries] + [(d, False) for d in found]
        place = [pa.array([group.column(c)[0].as_py()] * len(kept), group.schema.field(c).type) for c in ("family", "part", "copy")]
        return pa.table([*place, pa.array([d for d, _ in kept], pa.int64()), pa.array([x for _, x in kept], pa.bool_())],
                        names=["family", "part", "copy", "doc", "query"])

    return run


def _search(percent: int):
    """The queries of one group against its block of documents."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.select(["doc", "query", "set"]).to_pylist()
        members = sorted((r["doc"], r["set"]) for r in rows if not r["query"])
        index: dict[int, list[int]] = {}
        sizes = []
        for i, (_, raw) in enumerate(members):
            s = np.frombuffer(raw, np.uint64).tolist()
            sizes.append(len(s))
            for t in s:
                index.setdefault(t, []).append(i)
        found = []
        for doc, raw in {(r["doc"], r["set"]) for r in rows if r["query"]}:
            s = np.frombuffer(raw, np.uint64).tolist()
            n = len(s)
            near = [k for k in sizes if min(k, n) * 100 >= max(k, n) * percent]
            if not near:
                continue
            least = -(-(n + min(near)) * percent // (100 + percent))  # T for the smallest that may link
            lists = [index[t] for t in s if t in index]
            if len(lists) >= least:
                for i, both in divide_skip(lists, least, least - 1).items():
                    if 100 * both >= percent * (n + sizes[i] - both) and members[i][0] != doc:
                        found.append((doc, members[i][0]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return run


def _searched(routes: DataFrame, members: DataFrame, texts: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The links ``a, b`` between queries and the documents of the blocks they are
    routed to (``family, part, doc``). A block that many queries reach is copied, so
    no group holds more than about ``BLOCK`` of each. Only the documents that the
    sketches let pass are cut into shingles again."""
    spark = routes.sparkSession
    many = F.count(F.lit(1)).over(Window.partitionBy("family", "part"))
    dealt = written(routes.withColumn("copy", F.pmod(F.xxhash64("query"), F.ceil(many / BLOCK))), spark, "routes")
    blocks = dealt.select("family", "part", "copy").distinct().join(members, ["family", "part"])
    routed = written(dealt.select("family", "part", "copy", F.col("query").alias("doc"), F.lit(True).alias("query")).unionByName(
        blocks.select("family", "part", "copy", "doc", F.lit(False).alias("query"))), spark, "routed")
    group = ["family", "part", "copy"]
    rows = written(routed.join(sketches, "doc").groupBy(*group).applyInArrow(
        _screen(percent), routed.select(*group, "doc", "query").schema), spark, "screened")
    needed = written(rows.select(F.col("doc").alias("doc_id")).distinct(), spark, "needed")
    sets = texts.join(broadcast_if_small(needed), "doc_id", "left_semi").mapInArrow(_sets, "doc long, set binary")
    return rows.join(sets, "doc").groupBy(*group).applyInArrow(_search(percent), "a long, b long")


def _least_shared(qn, low, high, percent: int):
    """How many short lists two documents that link share at least. Of an overlap O, the
    document whose short lists end earlier in the global order holds all but T - 1 in
    them, and those are short lists of the other, too: O - max(T) + 1. One has ``qn``
    shingles, the other ``low`` to ``high``; sizes that cannot link are left out."""
    bottom = F.greatest(low, F.ceil(qn * percent / 100 - 1e-6))
    top = F.least(high, F.floor(qn * 100 / percent + 1e-6))
    overlap = F.ceil((bottom + qn) * percent / (100 + percent) - 1e-6)
    return F.greatest(overlap - F.ceil(F.greatest(top, qn) * percent / 100 - 1e-6) + 1, F.lit(1))


def _sizes_fit(low, high, qn, percent: int):
    return (high * 100 >= qn * percent) & (low * percent <= qn * 100)


def components(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id``."""
    one, many = _own_ids(docs)
    if many is None:
        return _components(docs, percent)
    return _of_nodes(one, many, percent).select("doc_id", "n_shingles", "component_id")


def _own_ids(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose doc_id is theirs alone (or null), and the others, all their columns and a
    ``__node`` of their own written down; None if there are no others."""
    spark = docs.sparkSession
    of = docs["doc_id"].cast("long")
    ids = docs.where(of.isNotNull()).groupBy(of.alias("__twice")).agg(F.count(F.lit(1)).alias("__rows"))
    twice = written(ids.where("__rows > 1").select("__twice"), spark, "repeated-ids")
    if twice.isEmpty():
        return docs, None
    side = broadcast_if_small(twice)
    above = docs.agg(F.max(of)).first()[0] + 1
    many = docs.join(side, of == side["__twice"], "left_semi").withColumn("__node", F.monotonically_increasing_id() + above)
    return docs.join(side, of == side["__twice"], "left_anti"), written(many, spark, "repeated-rows")


def _of_nodes(one: DataFrame, many: DataFrame, percent: int) -> DataFrame:
    """``node, doc_id, n_shingles, component_id`` and whether the row comes ``first`` in its component."""
    spark = one.sparkSession
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    nodes = one.select(*columns).unionByName(many.select(F.col("__node").alias("doc_id"), columns[1]))
    found = _components(nodes, percent).withColumnRenamed("doc_id", "node")
    names = many.select(F.col("__node").alias("of"), columns[0])
    found = found.join(broadcast_if_small(names), F.col("node") == F.col("of"), "left")
    found = written(found.select("node", F.coalesce("doc_id", "node").alias("doc_id"), "n_shingles", F.col("component_id").alias("label")), spark, "nodes")
    least = found.where("label is not null").groupBy("label").agg(F.min(F.struct("doc_id", "node")).alias("least"))
    out = found.join(least, "label", "left")
    return out.select("node", "doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"), (F.col("least.node") == F.col("node")).alias("first"))


def _components(docs: DataFrame, percent: int) -> DataFrame:
    """:func:`components` of rows that do not repeat a doc_id."""
    spark = docs.sparkSession
    texts = doc_texts(docs)
    profile = written(texts.mapInArrow(_profile, "doc_id long, n long, key binary, sketch binary, shingle long, times long"), spark, "profile")
    rows = profile.where("shingle is null").select("doc_id", "n", "key")
    frequent = profile.where("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("times"))
    top = frequent.orderBy(F.desc("times"), "shingle").limit(LONG_LISTS).toPandas()  # bounded
    top = top.assign(shingle=top["shingle"].to_numpy(np.int64).view(np.uint64)).sort_values("shingle")
    known = spark.sparkContext.broadcast((top["shingle"].to_numpy(np.uint64), top["times"].to_numpy(np.int64)))

    whole = rows.where("n > 0 and doc_id is not null")
    reps = written(whole.groupBy("key").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n")), spark, "representatives")
    others = written(whole.select("doc_id", "n").distinct().join(reps, F.col("doc_id") == F.col("doc"), "left_anti").unionByName(
        rows.where("n = 0").select("doc_id", "n")).select("doc_id").distinct(), spark, "copies")
    rep_texts = texts.where("doc_id is not null").join(broadcast_if_small(others), "doc_id", "left_anti")

    emitted = rep_texts.mapInArrow(_short_lists(known, percent), "shingle long, doc long")
    listed = emitted.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("shingle"))).where("members > 1")
    listed = written(listed.select("shingle", "doc", "members"), spark, "short-lists")
    per = listed.groupBy("doc").agg(F.sum("members").alias("weight"), F.count(F.lit(1)).alias("k")).join(reps.select("doc", "n"), "doc")
    lists = written(listed.drop("members").join(per, "doc"), spark, "sized-lists")
    sketches = profile.where("n > 0 and doc_id is not null").select(F.col("doc_id").alias("doc"), "n", "sketch")
    links = _links(lists, rep_texts, sketches, percent)
    labels = connected(links)

    of_rep = reps.join(labels, F.col("doc") == F.col("node"), "left").select(
        "key", F.coalesce("component", "doc").alias("component_id"))
    out = rows.join(of_rep, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _links(lists: DataFrame, texts: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between representatives that give the exact components."""
    spark = lists.sparkSession
    active = written(lists.select(F.col("doc").alias("doc_id")).distinct(), spark, "active")
    links = spark.createDataFrame([], "a long, b long")
    families = active.select(F.col("doc_id").alias("member"), F.col("doc_id").alias("family"))
    labelled = lists.withColumn("component", F.col("doc"))
    of_list = Window.partitionBy("shingle")
    for step in range(PIVOT_ROUNDS + 1):
        open_lists = labelled.withColumn("c0", F.min("component").over(of_list)).withColumn(
            "c1", F.max("component").over(of_list)).where("c0 < c1").drop("c0", "c1")
        open_lists = written(open_lists, spark, "open-lists")
        per = open_lists.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("k")).groupBy("shingle").agg(
            F.max_by("component", F.struct("k", "component")).alias("main"))
        if step == PIVOT_ROUNDS:
            break
        central = F.when(F.lit(step == 0) | (F.col("component") != F.col("main")), F.struct(
            "weight", F.col("doc").alias("pivot"), F.col("n").alias("qn"), F.col("component").alias("qc")))
        met = open_lists.join(per.select("shingle", "main"), "shingle").withColumn("p", F.max(central).over(of_list))
        met = met.select("doc", "n", "component", "p.pivot", "p.qn", "p.qc").where(
            (F.col("component") != F.col("qc")) & _sizes_fit(F.col("n"), F.col("n"), F.col("qn"), percent))
        pairs = met.groupBy("doc", "pivot", "n", "qn").count()
        enough = F.col("count") >= _least_shared(F.col("qn"), F.col("n"), F.col("n"), percent)
        best = written(pairs.groupBy("doc").agg(F.max_by(F.struct("pivot", enough.alias("enough")), F.struct("count", "pivot")).alias("p")).select(
            "doc", "p.pivot", "p.enough"), spark, "pivots")
        if step == 0:
            families = best.select(F.col("doc").alias("member"), F.col("pivot").alias("family"))
        best = best.where("enough")
        routes = best.select(F.col("doc").alias("query"), F.col("pivot").alias("family"), F.lit(0).alias("part"))
        heads = best.select(F.col("pivot").alias("family"), F.lit(0).alias("part"), F.col("pivot").alias("doc")).distinct()
        links = written(links.unionByName(_searched(routes, heads, texts, sketches, percent)), spark, "links")
        labels = connected(links)
        labelled = lists.join(labels, F.col("doc") == F.col("node"), "left").select(
            "shingle", "doc", "weight", "k", "n", F.coalesce("component", "doc").alias("component"))

    placed = active.join(families, F.col("doc_id") == F.col("member"), "left").select(
        F.col("doc_id").alias("doc"), F.coalesce("family", "doc_id").alias("family"))
    sizes = placed.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    own = lists.groupBy("doc").agg(F.first("n").alias("n"))
    members = written(placed.join(sizes, "family").join(own, "doc").select(
        "family", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("part"), "doc", "n"), spark, "blocks")
    ranges = members.groupBy("family", "part").agg(F.min("n").alias("n0"), F.max("n").alias("n1"))
    # of two components the smaller one asks, so all short lists that two documents share are counted once
    volume = labelled.select("doc", "component").distinct().groupBy("component").agg(F.count(F.lit(1)).alias("docs"))
    ranked = open_lists.join(volume, "component").withColumn("c", F.struct("docs", "component")).drop("docs", "component")
    met = ranked.join(members.drop("n"), "doc").groupBy("shingle", "family", "part").agg(
        F.max("c").alias("top"), F.min("n").alias("low"), F.max("n").alias("high")).join(ranges, ["family", "part"])
    queries = ranked.withColumn("largest", F.max("c").over(of_list)).where("c < largest").select(
        "shingle", F.col("doc").alias("query"), F.col("n").alias("qn"), "k", "c")
    least = _least_shared(F.col("qn"), F.col("n0"), F.col("n1"), percent)
    shared = queries.join(met, "shingle").where(
        (F.col("c") < F.col("top")) & _sizes_fit(F.col("low"), F.col("high"), F.col("qn"), percent) & (F.col("k") >= least))
    shared = shared.groupBy("query", "family", "part").agg(F.count(F.lit(1)).alias("shared"), F.first(least).alias("least"))
    routes = shared.where("shared >= least")
    found = _searched(routes.select("query", "family", "part"), members.drop("n"), texts, sketches, percent)
    return written(links.unionByName(found), spark, "links")


def keep_first(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all its columns.
    Rows that share a doc_id stay or go each by its own text; of equals one stays."""
    spark = docs.sparkSession
    one, many = _own_ids(docs)
    if many is None:
        found = _components(docs, percent).select(F.col("doc_id").alias("node"), (F.col("doc_id") == F.col("component_id")).alias("first"))
    else:
        found = _of_nodes(one, many, percent)
    dropped = written(found.where("not first").select(F.col("node").alias("__dropped")), spark, "near-copies")
    side = broadcast_if_small(dropped)
    kept = one.join(side, one["doc_id"].cast("long") == side["__dropped"], "left_anti")
    if many is None:
        return kept
    return kept.unionByName(many.join(side, many["__node"] == side["__dropped"], "left_anti").drop("__node"))
