"""The corpus pipeline, each stage against a plain account of its decision."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import mixing, ngram_join, packing, toxicity
from millrace.llm.common import table, written
from tests.conftest import rows

PLAIN = "river stone lamp cloud paper green quiet seven north metal glass honey field".split()
RUDE = "vile scum rotten filth wretch".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(11)
    texts = {i: " ".join(r.choices(PLAIN, k=r.randrange(8, 70))) for i in range(90)}
    for i in range(90, 120):
        texts[i] = " ".join(r.choices(RUDE + PLAIN[:3], k=r.randrange(10, 30)))
    for i in range(120, 130):
        texts[i] = texts[i - 120].upper() if i % 2 else texts[i - 120]
    for i in range(130, 140):  # one word put into a longer text
        words = (texts[i - 100] + " " + " ".join(PLAIN * 3)).split()
        texts[i - 100] = " ".join(words)
        texts[i] = " ".join(words[:5] + ["new"] + words[5:])
    texts |= {140: None, 141: "", 142: " \t", 143: "two words"}
    path = tmp_path_factory.mktemp("corpus")
    docs = [(i, t, r.choice(["en", None]), "c" if i % 3 else r.choice(["a", "b", None]), "extra") for i, t in texts.items()]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, size string").write.parquet(
        f"{path}/documents.parquet")
    marks = [(i, 1, int(90 <= i < 120)) for i in range(120)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = table(spark, folder, "documents")
    out = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = written(stage(spark, docs, folder), spark, "test-stage")
    return out


def _shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_toxic_documents_go_and_clean_ones_stay(spark, folder, stages):
    judged = toxicity.classify(stages[""], table(spark, folder, "labels"))
    clean = stages[""].join(judged.where("predicted = 0").select("doc_id"), "doc_id", "left_semi")
    assert rows(stages["toxicity"]) == rows(clean.select(stages[""].columns))
    kept = {x["doc_id"] for x in stages["toxicity"].collect()}
    assert set(range(90)) <= kept and len(kept & set(range(90, 120))) <= 3


def test_exact_copies_leave_the_largest_id(stages):
    largest = {}
    for x in stages["toxicity"].collect():
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in x["text"] or "")
        largest[text] = max(x["doc_id"], largest.get(text, -1))
    assert [x["doc_id"] for x in stages["exact_dedup"].orderBy("doc_id").collect()] == sorted(largest.values())
    assert stages["exact_dedup"].columns == stages[""].columns


def test_near_copies_leave_the_smallest_id(stages):
    sets = {x["doc_id"]: _shingles(x["text"]) for x in stages["exact_dedup"].collect()}
    group = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if v == old else v for k, v in group.items()}
    assert len(set(group.values())) < len(group)
    assert [x["doc_id"] for x in stages["ngram_jaccard"].orderBy("doc_id").collect()] == sorted(set(group.values()))


def test_mix_repeats_documents_by_their_taken_words(stages):
    taken = {x["doc_id"]: (x["taken"], x["size"]) for x in mixing.taken_words(stages["ngram_jaccard"]).collect()}
    before = {x["doc_id"]: x for x in stages["ngram_jaccard"].collect()}
    got = {}
    for x in stages["source_mixing"].collect():
        got.setdefault(x["doc_id"], []).append(x)
    assert set(got) == {i for i, (t, _) in taken.items() if t}
    for i, copies in got.items():
        t, size = taken[i]
        words = sorted((len(x["text"].split()) for x in copies), reverse=True)
        assert words == [size] * (t // size) + [t % size] * (t % size > 0)
        assert all(before[i]["text"].startswith(x["text"]) and [x[c] for c in x.__fields__ if c != "text"] == [
            before[i][c] for c in x.__fields__ if c != "text"] for x in copies)


def test_one_long_document_meets_its_target(spark):
    text = " \n" + " ".join(f"w{i}\t\n" for i in range(1000))
    docs = spark.createDataFrame([(1, text, "a", "x"), (2, "u v " * 4000, "b", "x"), (3, None, "a", "x")], "doc_id long, text string, source string, size string")
    target = {x["source"]: x["target"] for x in mixing.taken_words(docs).collect()}
    out = mixing.repeated(docs).collect()
    for source, of in (("a", 1), ("b", 2)):
        assert abs(sum(len(x["text"].split()) for x in out if x["source"] == source) - target[source]) <= 1 + 0.01 * target[source]
        assert {x["doc_id"] for x in out if x["source"] == source} == {of}
    assert all(text.startswith(x["text"]) for x in out if x["doc_id"] == 1)


def test_near_copies_of_a_repeated_id_go_by_their_texts(spark):
    x, y, z = "one two three four five six", "seven eight nine ten eleven twelve", "river stone lamp cloud paper green quiet"
    rows = [(3, x), (5, x), (5, y), (5, y), (7, z), (7, z), (9, z), (None, z), (11, None), (11, "")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, n_shingles string")
    kept = ngram_join.keep_first(docs).collect()
    key = lambda r: (str(r[0]), r[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=key) == sorted([(3, x), (5, y), (7, z), (None, z), (11, None), (11, "")], key=key)
    assert kept[0].__fields__ == docs.columns
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in ngram_join.components(docs).collect())
    assert got == sorted([("3", 2, 3), ("5", 2, 3), ("5", 2, 5), ("5", 2, 5), ("7", 3, 7), ("7", 3, 7), ("9", 3, 7), ("None", 3, None), ("11", 0, 11), ("11", 0, 11)])


def test_run_packs_every_token_of_the_mix(spark, folder, stages):
    pieces = corpus_pipeline.run(spark, folder)
    packed = pieces.groupBy("doc_id").agg(F.sum("length").alias("length")).collect()
    alone = {x["doc_id"]: x["length"] for x in packing.pack(stages["source_mixing"]).groupBy("doc_id").agg(F.sum("length").alias("length")).collect()}
    assert {x["doc_id"]: x["length"] for x in packed} == alone and set(alone) == {x["doc_id"] for x in stages["source_mixing"].collect()}
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").isEmpty()


def test_run_of_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
