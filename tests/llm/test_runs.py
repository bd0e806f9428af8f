"""Periodic runs against brute force over all periods and places."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import runs


def brute(words, least):
    """(start, period, end) of every run, by comparing all words at all distances."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, q, e) for (s, e), q in out.items() if e - s >= least)


def found(docs, least):
    return [[(int(s), int(q), int(e)) for s, e, q in rows] for rows in runs.runs_of(docs, least)]


def fibonacci(n):
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def family(draw):
    """One document of a kind that is hard for some step."""
    kind, n = draw.randrange(6), draw.randrange(300)
    letters = [bytes([c]) for c in b"abcdefgh"]
    if kind == 0:
        return [draw.choice(letters[:2]) for _ in range(n)]
    if kind == 1:
        return fibonacci(n)
    if kind == 2:  # one long run among other words
        root = [draw.choice(letters) for _ in range(draw.randrange(1, 80))]
        return [draw.choice(letters) for _ in range(15)] + (root * 6)[:draw.randrange(len(root), 5 * len(root) + 1)] + [b"z"] * 3
    if kind == 3:  # periods whose own words are periodic: (ab)^m a (ab)^m a ...
        root = [draw.choice(letters[:2]) for _ in range(draw.randrange(1, 5))]
        part = (root * 60)[:draw.randrange(1, 60 * len(root) + 1)]
        return [b"x"] * draw.randrange(4) + part * draw.randrange(2, 5) + part[:draw.randrange(len(part))]
    if kind == 4:  # runs within runs
        inner = [b"a"] * draw.randrange(1, 30) + [b"b"] * draw.randrange(3)
        outer = inner * draw.randrange(1, 8) + [b"c"] * draw.randrange(2)
        return (outer * draw.randrange(1, 5))[draw.randrange(5):][:500]
    base = [b"a", b"b"]
    one, two = base * draw.randrange(1, 50), base * draw.randrange(1, 50)
    return [w for _ in range(draw.randrange(1, 7)) for w in draw.choice([one, two, one[1:], two[:-1]])][:500]


@pytest.mark.parametrize("seed", range(12))
def test_all_runs_of_hard_documents(seed):
    draw = random.Random(seed)
    docs = [family(draw) for _ in range(8)]
    for least in (2, 12):
        assert found(docs, least) == [brute(d, least) for d in docs]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=80), max_size=4))
def test_all_runs_of_any_words(docs):
    assert found(docs, 2) == [brute(d, 2) for d in docs]


def test_long_document_stays_linear():
    words = [b"%d" % (i * i % 1009) for i in range(300_000)]
    [rows] = found([words], 12)
    assert rows[0] == (0, 1009, 300_000)


def account(doc_id, text):
    """The contract's row of one document, word by word."""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a, base = g % n, list(words)
            p = 1 + (n - a) // (3 + g % 8)
            for i in range(a, n):
                words[i] = base[a + (i - a) % p]
    every = brute(words, 12)
    dropped = {i for s, q, e in every for i in range(s + q, e)}
    best = min(((-(e - s), s, q) for s, q, e in every), default=None)
    shown = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(every), *shown, digest("".join(f"{s},{e - s},{q}\n" for s, q, e in every)),
            digest(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_equals_an_account_by_words(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice(["la", "la", "li", "loé", "x"]) for _ in range(draw.randrange(90))), "n") for i in range(60)]
    rows += [(i, " \t".join(f"w{draw.randrange(500)}" for _ in range(draw.randrange(200, 400))), "n") for i in range(60, 90)]
    rows += [(90, None, "n"), (91, "", "n"), (92, " \n ", "n"), (None, "a b " * 20, "n"), (None, None, None), (7, "twice " * 30, "n"), (-3, "z " * 13, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string")  # a column of a clashing name
    out = runs.detect(docs).collect()
    key = lambda r: str(tuple(r))
    assert sorted((tuple(r)[:8] for r in out), key=key) == sorted((account(i, t) for i, t, _ in rows), key=key)
    assert any(r["n_runs"] and zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in out if r["doc_id"] and r["doc_id"] >= 60)


def test_empty_table_and_digests_of_nothing(spark):
    assert runs.detect(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert runs.described([], np.empty((0, 3), np.int64))[5] == hashlib.sha256(b"").hexdigest()
