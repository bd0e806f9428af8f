"""The training-data operators against brute force, on small and odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ann, chat, dac, exact_dedup, mixing, ngram_join, packing, pii, quality, toxicity
from millrace.llm.common import workers_find_package
from millrace.llm.tokens import Encoder

WORDS = "stone river lamp cloud paper green quiet seven north metal glass honey".split()


@pytest.fixture(scope="module")
def docs(spark):
    workers_find_package(spark)
    r = random.Random(5)
    rows = [(i, " ".join(r.choices(WORDS, k=r.randrange(5, 60))), r.choice(["a", "b", None])) for i in range(60)]
    long = " ".join(r.choices(WORDS, k=4000))
    base = rows[7][1].split() + r.choices(WORDS, k=80)
    rows += [(60 + k, " ".join(base[:k * 3] + ["new"] + base[k * 3:]), "a") for k in range(6)]
    rows += [(70, None, "a"), (71, "", None), (72, " \t ", "b"), (73, rows[3][1].upper(), "a"), (74, rows[3][1], "b"),
             (75, long, "c"), (76, "two words", "a"), (77, "Two words", "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))


def _sets(rows):
    out = {}
    for x in rows:
        w = (x["text"] or "").encode().lower().split()
        out[x["doc_id"]] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    return out


def test_components_match_all_pairs(docs):
    sets = _sets(docs.collect())
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.components(docs).collect()}
    assert got == {i: (len(sets[i]), top(i)) for i in sets}


def test_five_words_link_with_longer_texts_of_the_same_shingle(spark):
    texts = ["a a a a a", "a a a a a a", "A a a a a a a a", "a b c d e", "a b c d e a b c d", "a a a a"]
    sets = _sets({"doc_id": i, "text": t} for i, t in enumerate(texts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.components(docs).collect()}
    assert got == {i: (len(s), min(j for j, z in sets.items() if 100 * len(s & z) >= 75 * len(s | z))) for i, s in sets.items()}
    assert got[1] == got[2] == (1, 0)


def test_divide_skip_counts_exactly():
    r = random.Random(2)
    for _ in range(200):
        lists = [sorted(r.sample(range(12), r.randrange(12))) for _ in range(r.randrange(1, 9))]
        least = r.randrange(1, 6)
        counts = {i: sum(i in x for x in lists) for i in range(12)}
        assert ngram_join.divide_skip(lists, least, least - 1) == {i: n for i, n in counts.items() if n >= least}


def test_sketch_bounds_the_overlap_from_above():
    r = np.random.default_rng(4)
    pool = np.unique(r.integers(0, 1 << 64, 9000, dtype=np.uint64))
    for n, m in ((1, 1), (1, 2), (30, 39), (700, 900), (1023, 1025), (5000, 6500)):
        for _ in range(5):
            a, b = (np.sort(r.choice(pool, k, replace=False)) for k in (n, m))
            both = len(np.intersect1d(a, b))
            x, y = (ngram_join.buckets(ngram_join.sketch(v)) for v in (a, b))
            assert both <= ngram_join.most_shared(x, y) == ngram_join.most_shared(y, x) <= n
            assert ngram_join.most_shared(x, x) == n
    crowded = np.arange(40, dtype=np.uint64)  # all in one bucket: no bound, so nothing is screened out
    assert ngram_join.sketch(crowded) == b""
    assert ngram_join.most_shared(ngram_join.buckets(b""), x) == np.inf


def test_exact_dedup(docs):
    groups = defaultdict(list)
    for x in docs.collect():
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in x["text"] or "")
        groups[text].append(x["doc_id"])
    want = {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    got = {x["doc_id"]: (x["keep_id"], x["group_size"], x["kept"], bytes(x["digest"]).hex()) for x in exact_dedup.deduplicate(docs).collect()}
    assert got == want
    stay = exact_dedup.drop_duplicates(docs.unionByName(docs))
    assert sorted(x["doc_id"] for x in stay.collect()) == sorted(i for i, w in want.items() if w[2])


def test_index_remembers_earlier_batches(spark, docs):
    index = exact_dedup.DigestIndex(spark, "seen_digests", buckets=2)
    exact_dedup.deduplicate(docs, index).count()
    size = index.rows().count()
    again = exact_dedup.deduplicate(docs.withColumn("doc_id", F.col("doc_id") + 1000), index)
    assert again.where("kept").isEmpty() and index.rows().count() == size


def test_mixing_reaches_targets(docs):
    rows = mixing.taken_words(docs).collect()
    size = {x["doc_id"]: len((x["text"] or "").split()) for x in docs.collect()}
    taken, target = defaultdict(int), {}
    for x in rows:
        assert x["size"] == size[x["doc_id"]] and 0 <= x["taken"] <= 2 * x["size"]
        taken[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
    assert len(rows) == len(size)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6 * sum(size.values())
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(4, 0.02 * t)


def test_token_codes_round_trip(spark, docs, tmp_path):
    dac.write(docs, str(tmp_path / "codes"))
    whole = Encoder("byte_bpe_50k.json").tokenizer
    start, stream = 0, []
    got = {x["doc_id"]: x for x in dac.read_documents(spark, str(tmp_path / "codes")).collect()}
    for x in sorted(docs.collect(), key=lambda x: x["doc_id"]):
        ids = np.array([*whole.encode(x["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        g = got[x["doc_id"]]
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
        stream += ids.tolist()
    wanted = spark.createDataFrame([(i,) for i in range(0, start, 97)], "position long")
    assert {x["position"]: x["token"] for x in dac.tokens_at(spark, str(tmp_path / "codes"), wanted).collect()} == {
        i: stream[i] for i in range(0, start, 97)}


def test_packing_covers_every_token_without_padding(docs):
    pieces = packing.pack(docs).collect()
    tokens = defaultdict(list)
    for p in pieces:
        tokens[p["doc_id"]].append(p)
    whole = Encoder("word_bpe_49k.json").tokenizer
    for x in docs.collect():
        ids, at = np.array([*whole.encode(x["text"] or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for p in sorted(tokens[x["doc_id"]], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert zlib.crc32(ids[at:at + p["length"]].tobytes()) == p["ids_crc32"]
            at += p["length"]
        assert at == len(ids)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at & (at - 1) == 0 and at <= 4096


def test_neighbours(spark):
    r = np.random.default_rng(1)
    x = r.standard_normal((300, 16))
    x[10:40] = x[10]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(300, None), (400, [0.0] * 16), (500, [float("nan")] + [1.0] * 15), (600, [1.0, 2.0])]
    got = defaultdict(list)
    for row in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect():
        got[row["query_id"]].append(row["vec_id"])
    x = x.astype(np.float32).astype(float)
    hits = 0
    for q in (0, 100, 200):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        hits += len({int(i) for i in np.lexsort((np.arange(300), d)) if i != q and True and i in got[q]} & set(
            [int(i) for i in np.lexsort((np.arange(300), d)) if i != q][:10]))
    assert sorted(got) == [0, 100, 200] and hits >= 27


def test_chat_reads_back(spark):
    hard = r"\[INST] a\\ [\INST] </s><s> <<SYS>> [/ROLE] é"
    rows = [(1, 0, "system", hard), (1, 1, "user", hard), (1, 2, "assistant", hard * 40), (1, 3, "tool[/ROLE]", ""), (1, 3, "assistant", None),
            (None, 0, None, "x"), (2, None, "assistant", "a"), (2, 0, "assistant", "b")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x["conv_id"]: x for x in chat.read_back(chat.format_events(chat.event_log(table))).collect()}
    order = {1: [rows[0], rows[1], rows[2], rows[4], rows[3]], None: [rows[5]], 2: [rows[6], rows[7]]}
    for conv, turns in order.items():
        said = "".join(f"{r or ''}\n{t or ''}\n" for *_, r, t in turns)
        loss = "".join(t or "" for *_, r, t in turns if r == "assistant")
        assert (got[conv]["n_turns"], got[conv]["turns_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for text in (hard, "\\", "[\\", "\\[INST]", ""):
        segment, a, b = chat.render("assistant", text)
        assert chat.parse(segment) == ("assistant", text) and chat.unescape(segment[a:b]) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_pii_base_spans_match_the_patterns():
    import re

    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    r = random.Random(1)
    for _ in range(5000):
        text = "".join(r.choice("a1.@-2 +(_3") for _ in range(r.randrange(40)))
        want = {(m.start(), 0, m.end()) for m in email.finditer(text)}
        want |= {(m.start(), 1, m.end()) for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))}
        assert {s for s in pii.base_spans(text) if s[1] < 2} == want
    text = "card 4111 1111 1111 1111, call +1 (212) 555-0188."
    assert pii.redact(text, pii.base_spans(text)) == "card <card>, call <phone>."


def _luhn(digits):
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def test_pii_cards_phones_counts_and_digest_match_the_patterns(spark):
    import re

    forms = ((0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), (1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             (2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]"))
    r = random.Random(9)
    parts = ["4111 1111 1111 1111", "4111111111111112", "+1 (212) 555-0188", "+12", "10.0.0.255", "1.2.3.256", "a@b.c", "é", " ", "-", "4", "00", "+", "5500-0000-0000-0004", "x"]
    rows = [(i, "".join(r.choices(parts, k=r.randrange(12)))) for i in range(400)] + [(400, None), (401, "")]
    out = {x["doc_id"]: x for x in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        found = []
        for kind, form in forms:
            for m in re.finditer(form, text or ""):
                digits = re.sub("[^0-9]", "", m[0])
                fit = (True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True, 14 <= len(digits) <= 19 and _luhn(digits),
                       10 <= len(digits) <= 15)[kind]
                found += [(m.start(), kind, m.end())] if fit else []
        found.sort()
        names = ("email", "ip", "card", "phone")
        assert [out[i][f"n_{n}"] for n in names] == [sum(k == j for _, k, _ in found) for j in range(4)], text
        assert out[i]["base_sha256"] == hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in found).encode()).hexdigest()
        every = out[i]["spans"].split(",") if out[i]["spans"] else []
        assert {f"{names[k]}:{a}:{b}" for a, k, b in found} <= set(every) and len(every) == len(found) + out[i]["n_added"]


def test_pii_time_grows_with_the_text():
    import time

    class Sure:
        def probability(self, x):
            return np.full(len(x), 0.99)

    finder = pii.Finder(Sure())
    text = "call +1 (212) 555-0188 or 212-555-0188, a@b.org, a at b dot org, 10.1.2.3; " * 4000
    start = time.perf_counter()
    base, more = finder.spans(text)
    took = time.perf_counter() - start
    assert len(base) >= 12000 and len(more) >= 4000 and took < 60
    assert all(a[2] <= b[0] for a, b in zip(more, more[1:]))
    cover = pii.Cover([(0, 0, 3), (2, 1, 5), (9, 0, 12)])
    assert [cover.meets(a, a + 2) for a in range(12)] == [True] * 5 + [False] * 3 + [True] * 4


def test_pii_thresholds_are_calibrated():
    p = np.array([0.99] * 60 + [0.8] * 30 + [0.6] * 30)
    y = np.array([1] * 60 + [1] * 30 + [0] * 30, float)
    assert pii.calibrated(p, y) == 0.8 and pii.calibrated(p, 1 - y) == 1.0 and pii.calibrated(p[:10], y[:10]) == pii.THRESHOLD


def test_pii_candidates_of_spelled_addresses_without_a_dot_word():
    for at in ("@", "(at)", "[AT]", "{at}", " at ", " [at] ", " (At) "):
        text = f"Please write john.smith{at}example.com, thanks"
        assert (13, 0, text.index(",")) in {(a, k, b) for a, k, b in pii.candidates(text)}
    assert pii.candidates("that hat is flat. attend") == []


def test_classifiers_learn(spark):
    workers_find_package(spark)
    r = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words, bad, rude = r.choices(WORDS, k=40), i % 4 == 0, i % 5 == 0
        words = [w + "###" for w in words] if bad else words
        rows.append((i, " ".join(words[:20] + (["blockhead"] if rude else []) + words[20:])))
        labels.append((i, int(not bad), int(rude)))
    docs = spark.createDataFrame([*rows, (400, None)], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for module, column in ((quality, "quality"), (toxicity, "toxic")):
        got = {x["doc_id"]: x for x in module.classify(docs, marks).collect()}
        want = {i: (q if column == "quality" else t) for i, q, t in labels}
        assert len(got) == 401 and all(0 <= x["score"] <= 1 for x in got.values())
        held = [i for i in want if got[i]["held_out"]]
        assert sum(got[i]["predicted"] == want[i] for i in held) >= 0.95 * len(held)


def test_block_max_index_is_exact_and_skips_blocks():
    r = np.random.default_rng(3)
    vectors = []
    for i in range(1500):  # ten topics with terms of their own, and a few light ones that all share
        t = np.unique(np.concatenate([r.choice(30, r.integers(1, 8)) + 40 * (i % 10), 400 + r.choice(30, 2)]))
        w = np.where(t < 400, r.random(len(t)), 0.1)
        vectors.append((t, w / np.linalg.norm(w)))
    vectors += vectors[:100]  # ties
    n = len(vectors)
    dense = np.zeros((n, 430))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    ends = np.cumsum([0, *[len(t) for t, _ in vectors]])
    index = toxicity.BlockMaxIndex(430, ends, np.concatenate([t for t, _ in vectors]).astype(np.int32), np.concatenate([w for _, w in vectors]))
    for i in range(0, n, 25):
        cos = np.round(dense @ dense[i], 12)
        cos[i] = 0
        want = [int(j) for j in np.lexsort((np.arange(n), -cos)) if cos[j] > 0][:15]
        got = index.nearest(*vectors[i], skip=i)
        assert index.nearest_of([vectors[i], vectors[0]], skips=[i, 0])[0] == got
        assert [j for j, _ in got] == want and [c for _, c in got] == pytest.approx(cos[want])
    assert index.asked == 192 and index.evaluated < 0.7 * index.asked * index.blocks


def test_toxic_neighbours_rest_on_all_terms(spark):
    workers_find_package(spark)
    r = random.Random(6)
    rows = [(i, " ".join(r.choices(WORDS, k=12))) for i in range(60)] + [(60, "Rare insult"), (61, "rare insult"), (62, "unheard of")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learned = [i for i in range(61) if zlib.crc32(str(i).encode()) % 5]
    assert 60 in learned
    toxic = {i: int(i % 4 == 0) for i in learned}
    marks = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    counts = {i: Counter(t for t in map(toxicity.term_of, text.lower().split()) if t) for i, text in rows}
    n, ones = len(learned), sum(toxic.values())

    def weight(term, times):
        p = sum(term in counts[i] for i in learned if toxic[i]) / ones
        q = sum(term in counts[i] for i in learned if not toxic[i]) / (n - ones)
        error = np.sqrt(max((p + q) / 2 * (1 - (p + q) / 2) * (1 / ones + 1 / (n - ones)), 1e-12))
        df = sum(term in counts[i] for i in learned)
        return (1 + np.log(times)) * (np.log((n + 1) / (df + 1)) + 1) * (1 + abs(p - q) / error)

    weights = {i: {t: weight(t, k) for t, k in c.items()} for i, c in counts.items()}
    norms = {i: np.sqrt(sum(x * x for x in w.values())) for i, w in weights.items()}  # of all terms, known or not
    got = {x["doc_id"]: dict(zip(x["neighbours"], x["similarities"])) for x in toxicity.classify(docs, marks).collect()}
    assert got[61] == {60: pytest.approx(1)} and got[62] == {}
    for i, near in got.items():
        cos = {j: sum(x * weights[j].get(t, 0) for t, x in weights[i].items()) / norms[i] / norms[j] for j in learned if norms[i]}
        want = sorted((c for c in cos.values() if c > 0), reverse=True)[:toxicity.NEAREST]
        assert sorted(near.values(), reverse=True) == pytest.approx(want)
        assert all(c == pytest.approx(cos[j]) for j, c in near.items())


def test_terms_of_words_and_bounded_cache(monkeypatch):
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 2)
    words = toxicity.Vocabulary({"river": 0, "stone": 1})
    for _ in range(3):  # unknown terms get numbers beyond the known ones, marks none
        which, times = words.counts("Rivers, STONE rivered ... new! new (newer)")
        assert which.tolist()[:2] == [0, 1] and times.tolist()[:2] == [2, 1]
        assert sorted(times.tolist()[2:]) == [1, 2] and all(i >= 2 for i in which.tolist()[2:])
    assert [x.tolist() for x in words.counts("")] == [[], []] == [x.tolist() for x in words.counts(" . ! ")]


def test_labelled_sample_is_one_row_per_document(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "d"), (3, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 1), (2, 0), (3, 1), (4, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    rows = {r["doc_id"]: (r["text"], r["label"]) for r in quality.labelled_sample(docs, marks, "toxic").collect()}
    want = {1: ("a", 1), 2: ("c", 0), 3: ("", 1)}
    assert rows == {i: x for i, x in want.items() if zlib.crc32(str(i).encode()) % 5}
    few = toxicity._sampled(docs, marks, "toxic", 10, 1)
    assert few.count() <= len(rows) and few.agg(F.sum(F.octet_length("text"))).first()[0] <= 1


def test_empty_tables(spark):
    workers_find_package(spark)
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frames = (ngram_join.components(empty), exact_dedup.deduplicate(empty), mixing.taken_words(empty), packing.pack(empty),
              pii.find(empty), quality.classify(empty, marks), toxicity.classify(empty, marks))
    assert all(f.count() == 0 for f in frames)
