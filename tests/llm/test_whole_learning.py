"""Models that are learned from every labelled row or candidate."""

import zlib

import numpy as np

from millrace.llm import quality
from millrace.llm.common import workers_find_package


def _learned(i):
    return zlib.crc32(str(i).encode()) % 5 != 0


def test_quality_learns_from_all_labelled_documents(spark):
    workers_find_package(spark)
    rows = [(i, "word " * (i % 13 + 1) + "end" if i % 20 else "## " * (i % 7 + 2)) for i in range(6000)]
    rows += [(3, "zzz a second text"), (5, rows[5][1])]  # of two texts the smaller counts
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 20 > 0)) for i in range(6000)], "doc_id long, quality int")
    ranker = quality.train(docs, marks)
    x = np.array([quality.features(t.encode()) for i, t in rows[:6000] if _learned(i)])
    assert len(x) > 4500 and np.allclose(ranker.mean, x.mean(axis=0)) and np.allclose(ranker.scale, np.maximum(x.std(axis=0), 1e-6))
    right = {r["doc_id"]: r["predicted"] for r in quality.classify(docs, marks).collect()}
    assert np.mean([right[i] == int(i % 20 > 0) for i in range(6000)]) > 0.99


def test_every_row_is_in_a_pair(spark):
    workers_find_package(spark)
    rows = [(i, int(i % 50 > 0), [float(i)] + [0.0] * (quality.FEATURES - 1)) for i in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, label int, x array<double>")

    class Plain:
        def standard(self, x):
            return np.column_stack([x[:, 0] * (x[:, 0] % 50 > 0), x[:, 0] * (x[:, 0] % 50 == 0), x[:, 2:]])

    good, bad = set(), set()
    for r in quality.pairs(frame, (20, 980), Plain(), bucket=128).collect():
        d = np.frombuffer(r["differences"], np.float32).reshape(-1, quality.FEATURES)
        assert len(d)
        good |= set(d[:, 0].astype(int))
        bad |= set(-d[:, 1].astype(int))
    assert good == {i for i in range(1000) if i % 50} and bad == {i for i in range(1000) if i % 50 == 0}


def test_pii_learns_from_every_candidate(spark):
    from millrace.llm import boosting, pii

    text = "call 212-555-0188 or +1 (212) 555-0188, a@b.org; " * 40  # more spans than were drawn of a document
    rows = list(pii.examples(1, text))
    assert sum(y for _, y in rows) >= 2 * 80 and sum(1 - y for _, y in rows) > 80 and {len(x) for x, _ in rows} == {pii.FEATURES}
    x = [([float(i % 2), float(i), 0.0], int(i % 2 and i > 300), i % 7 and (i % 5 == 0)) for i in range(1000)]
    frame = spark.createDataFrame([(v, y, int(bool(p))) for v, y, p in x], "x array<double>, y int, part int").repartition(3)
    model, blocks = boosting.fit(frame, 3, trees=8)
    assert boosting.total(blocks, 3, boosting.FIT, lambda b, y: np.array([len(y), y.sum()])).tolist() == [
        sum(not p for *_, p in x), sum(y for _, y, p in x if not p)]
    p = model.probability(np.array([v for v, *_ in x]))
    assert np.mean((p > 0.5) == np.array([y for _, y, _ in x])) > 0.97
    bins = np.column_stack([np.searchsorted(c, np.array([v[f] for v, *_ in x])) for f, c in enumerate(boosting.edges(frame, 3))])
    assert np.allclose(model.binned_margin(bins), model.margin(np.array([v for v, *_ in x])))
