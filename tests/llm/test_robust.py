"""Base counts against Python's own, and the robust estimate against numpy."""

import random
import re

import numpy as np
import pytest

from millrace.llm import robust

GAP = " \t\n\x0b\x0c\r"


def counts(text):
    """The contract's counts, word by word."""
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(GAP)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def made_up(draw, n):
    out = []
    for i in range(n):
        words = ["".join(draw.choice("abcdefghé") for _ in range(draw.randrange(1, 9))) for _ in range(int(draw.lognormvariate(5, 0.5)) + 40)]
        if i % 11 == 0:
            words += words[:12] * 2
        if i % 17 == 0:
            words = [w + draw.choice(["", "#", "$%", "<b>"]) for w in words]
        gaps = [draw.choice([" ", " ", " ", "\n", "\t", " \n\n", "\x0b"]) for _ in words]
        out.append("".join(w + g for w, g in zip(words, gaps, strict=True)))
    return out


def test_counts_equal_an_account_by_words(spark):
    draw = random.Random(3)
    texts = [" ".join(draw.choice(["a", "b", "c", "dé"]) for _ in range(draw.randrange(40))) for _ in range(60)]
    texts += ["\n".join(draw.choice(["x y", "x y ", "", " ", "\t", "#", "é|é"]) for _ in range(draw.randrange(12))) for _ in range(60)]
    texts += [None, "", " \n ", "one", "a a a", "a a a a", "a b c a b c", "\x85    ", "\n\na\r\na\r\n", "|<>|" * 5, "w " * 5000, *made_up(draw, 5)]
    docs = spark.createDataFrame([(i, t, None, "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = robust.counted(docs).orderBy("doc_id").collect()
    assert [tuple(r)[3:] for r in got] == [counts(t) for t in texts]


def estimate(x):
    """Mean, inverse covariance and factor by the same steps on one group's matrix."""
    floors = np.diag(np.square(robust.FLOORS))
    quartiles = np.percentile(x, [25, 50, 75], axis=0)
    centre = np.floor(quartiles[1] + 0.5)
    spread = np.maximum((quartiles[2] - quartiles[0]) / 1.349, robust.FLOORS)

    def bins(mean, inverse):
        y = x - centre - mean
        return np.floor(np.log1p(np.einsum("ij,jk,ik->i", y, inverse, y)) * robust.BINS).astype(int)

    def fit(rows):
        y = x[rows] - centre
        return y.mean(axis=0), np.linalg.inv(np.cov(y.T, bias=True) + floors)

    def factor(b):
        middle = np.sort(b)[(len(b) + 1) // 2 - 1]
        return max(1.0, (np.exp((middle + 0.5) / robust.BINS) - 1) / robust.CHI_MEDIAN)

    now = np.zeros(x.shape[1]), np.diag(1 / spread ** 2)
    for _ in range(robust.STEPS):
        b = bins(*now)
        now = fit(b <= np.sort(b)[int(np.ceil(len(b) * robust.SUBSET)) - 1])
    b = bins(*now)
    now = fit((np.exp(b / robust.BINS) - 1) / factor(b) <= robust.REWEIGHT)
    y = x - centre - now[0]
    return np.einsum("ij,jk,ik->i", y, now[1], y) / factor(bins(*now))


def test_distances_equal_numpy_per_group(spark):
    draw = random.Random(8)
    texts = made_up(draw, 420)
    # big groups judge themselves; small sources their language; a small language all documents
    place = [("en", "a")] * 150 + [("en", None)] * 120 + [("en", "b")] * 30 + [(None, "a")] * 110 + [("fr", "a")] * 10
    docs = spark.createDataFrame([(i, t, *p, 1) for i, (t, p) in enumerate(zip(texts, place, strict=True))],
                                 "doc_id long, text string, lang string, source string, kept int")
    out = robust.judge(docs).toPandas().set_index("doc_id").sort_index()
    stats = robust.statistics(robust.counted(docs)).toPandas().set_index("doc_id").sort_index()
    x = stats[[f"x{i}" for i in range(robust.DIM)]].to_numpy(float)
    good = ~stats["base_failed"].to_numpy()
    en = np.array([p[0] == "en" for p in place])
    own = {p: np.array([q == p for q in place]) for p in set(place)}
    for p, rows in own.items():
        of = rows if (rows & good).sum() >= 100 else en if p[0] == "en" else np.ones(len(rows), bool)
        every = estimate(x[of & good])
        want = every[(rows & good)[of & good]]
        got = out["distance"].to_numpy()[rows & good]
        assert np.allclose(got, want, rtol=1e-6), p
    assert (out["kept"].to_numpy() == (good & (out["distance"].to_numpy() <= robust.CUT))).all()
    marked = np.arange(len(texts)) % 17 == 0  # every seventeenth text is full of symbols
    assert not out["kept"].to_numpy()[marked & good].any() and out["kept"].to_numpy()[~marked & good].mean() > 0.97


def test_defined_cases(spark):
    schema = "doc_id long, text string, lang string, source string, n_words string"
    assert robust.judge(spark.createDataFrame([], schema)).collect() == []
    few = [(1, None, None, None, "x"), (2, "", "en", "a", "x"), (2, "w " * 60, "en", "a", "x"), (None, " ".join(map(str, range(60))), "en", "a", "x")]
    out = robust.judge(spark.createDataFrame(few, schema)).collect()
    assert sorted((str(r.doc_id), r.base_failed, r.kept, r.distance) for r in out) == [
        ("1", True, False, None), ("2", True, False, None), ("2", True, False, None), ("None", False, True, None)]
    same = [(i, " ".join(f"w{k:03d}" for k in range(80)), "en", "a", "x") for i in range(120)]  # all alike, and one odd
    out = robust.judge(spark.createDataFrame([*same, (200, " ".join(f"{'#$' * 9}{k}" for k in range(80)), "en", "a", "x")], schema)).collect()
    assert {r.doc_id for r in out if not r.kept} == {200}


@pytest.mark.parametrize("part", ["key", "level"])
def test_group_keys_differ(spark, part):
    rows = spark.createDataFrame([("a", None), (None, "a"), (None, None), ("a", "a"), ("null", None)], "lang string, source string")
    keys = [r[0] for r in rows.select(robust._key(0, "lang", "source")).collect()]
    assert len(set(keys)) == 5 and rows.select(robust._key(1, "lang")).first()[0] not in keys
