"""What a reused Python worker holds: batches, caches, counts and index stay small."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from millrace.llm import common, ngram_join, toxicity

tokens = pytest.importorskip("millrace.llm.tokens")


def test_batches_are_bounded_in_bytes(spark, tmp_path):
    session = spark.newSession()
    rows = session.range(200, numPartitions=1).selectExpr("id doc_id", "repeat('x', 100000) text")
    rows.write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["bytes"])

    found = [r["bytes"] for r in common.table(session, str(tmp_path), "documents").mapInArrow(sizes, "bytes long").collect()]
    assert sum(found) > 20_000_000 and max(found) < 9 << 20
    own = spark.newSession()
    own.conf.set(common._BATCH_SETTING, "3m")
    common.bounded_batches(own)
    assert own.conf.get(common._BATCH_SETTING) == "3m"


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cache_takes_pieces_met_again(name):
    every, again = tokens.Encoder(name), tokens.Encoder(name, again=True)
    texts = [f"once{i} often, Often é{i}\nnext" for i in range(50)] + [""]
    assert [again.encode(t) for t in texts] == [every.encode(t) for t in texts]
    assert "often," in again and len(again) < len(every) / 2
    assert again.encode(texts[3]) == again.encode(texts[3]) == every.whole(texts[3])


@pytest.mark.parametrize("window", [1, 4_000_000])
def test_shingles_are_counted_over_windows(monkeypatch, window):
    monkeypatch.setattr(ngram_join, "TASK_WINDOW", window)
    monkeypatch.setattr(ngram_join, "TASK_LEAST", 2)
    texts = ["a b c d e", "a b c d e", "f g h i j k", "f g h i j", "a b c d e", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["doc_id", "text"])
    rows = pa.Table.from_batches(ngram_join._profile(iter([batch]))).to_pylist()
    assert [r["n"] for r in rows if r["shingle"] is None] == [1, 1, 2, 1, 1, 0]
    of = {int(ngram_join.shingles(t.encode()).view(np.int64)[0]): n for t, n in ((texts[0], 3), (texts[3], 2))}
    assert {r["shingle"]: r["times"] for r in rows if r["shingle"] is not None} == of


def test_index_lists_are_narrow():
    ends = np.array([0, 2, 4, 6])
    cols = np.array([0, 1, 0, 2, 1, 2], np.int32)
    vals = np.full(6, 0.5 ** 0.5)
    index = toxicity.BlockMaxIndex(3, ends, cols, vals)
    assert index.at.itemsize == index.weights.itemsize == 4
    assert index.nearest(np.array([0, 1]), vals[:2], k=2) == [(0, 1.0), (1, 0.5)]


def test_a_worker_gives_memory_back_after_its_last_batch(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b"])], names=["text"])
    assert sum(b.num_rows for b in common.slices(iter([batch, batch]))) == 4 and given == [1]
    assert list(common.slices(iter([]))) == [] and given == [1, 1]


def test_batches_leave_room_for_copies():
    assert common.BATCH_BYTES <= common.SLICE_BYTES // 2


def test_cache_of_pieces_met_again_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "AGAIN_PIECES", 30)
    every, again = tokens.Encoder("word_bpe_49k.json"), tokens.Encoder("word_bpe_49k.json", again=True)
    texts = [f"a{i % 200}b c{i % 200}d e{i % 200}f" for i in range(600)]
    held = []
    for t in texts:
        assert again.encode(t) == every.encode(t)
        held.append(len(again))
    assert max(held) <= 33 and len(every) > 300


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_start_with_what_was_kept_given_back(spark, tmp_path, stage):
    def keep(batches):
        common.WARM[:] = [{"kept": 1}]
        yield from batches

    def kept(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, common.WARM))] * batch.num_rows, pa.int64())], names=["id"])

    def collections():
        beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans)

    spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "web")], "doc_id long, text string, lang string, source string")
    cores = spark.sparkContext.defaultParallelism
    tasks = spark.range(0, 4 * cores, 1, cores)
    assert tasks.mapInArrow(keep, "id long").count() == 4 * cores
    before = collections()
    stage(spark, docs, str(tmp_path))
    assert collections() > before
    met = [r["id"] for r in tasks.mapInArrow(kept, "id long").collect()]
    assert len(met) == 4 * cores and sum(met) <= len(met) // 2  # a worker may be missed
