"""Folder comparison: presence matrix and `diff -wB` content equality."""

from millrace.operators import compare
from tests.conftest import rows


import pytest


@pytest.mark.parametrize("by_line", [False, True])
def test_compare_folders(spark, tmp_path, by_line):
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir()
    b.mkdir()
    (a / "same.txt").write_text("hello world\nline two\n")
    (b / "same.txt").write_text("hello   world\n\n\n  line\ttwo  \n")
    (a / "diff.txt").write_text("ab\nc\n")
    (b / "diff.txt").write_text("a\nbc\n")  # same characters, other line split
    (a / "only_a.txt").write_text("x")
    (b / "only_b.txt").write_text("y")
    (a / "blank.txt").write_text(" \n\n")
    (b / "blank.txt").write_text("")
    got = rows(compare.compare_folders(spark, str(a), str(b), by_line=by_line))
    assert got == [("blank.txt", "Y", "Y", "Y"), ("diff.txt", "Y", "Y", "N"), ("only_a.txt", "Y", "N", "N/A"),
                   ("only_b.txt", "N", "Y", "N/A"), ("same.txt", "Y", "Y", "Y")]


def test_presence_matrix(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "file_name string")
    right = spark.createDataFrame([("b",), ("c",)], "file_name string")
    assert rows(compare.presence_matrix(left, right)) == [("a", "Y", "N"), ("b", "Y", "Y"), ("c", "N", "Y")]


def test_whole_text_normalisation_equals_per_line(spark):
    import random
    from pyspark.sql import functions as F
    rnd = random.Random(3)
    alphabet = ["a", "b", " ", "\t", "\n", "\r", "\x0b", "\x0c", " ", "é"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(compare.normalised_text(F.col("t")).alias("a"),
                    F.array_join(compare.normalised_lines(F.col("t")), "\n").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)


def test_line_level_compare_with_many_splits(spark, tmp_path):
    import random
    rnd = random.Random(11)
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir()
    b.mkdir()
    words = ["alpha", "beta", "gamma", "delta", " ", "\t"]
    for i in range(6):
        lines = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 8))) for _ in range(400)]
        text = "\n".join(lines)
        (a / f"f{i}.txt").write_text(text)
        other = text.replace(" ", "  ") if i % 2 == 0 else text + "\nextra"
        (b / f"f{i}.txt").write_text(other)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        by_line = rows(compare.compare_folders(spark, str(a), str(b), by_line=True))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert by_line == rows(compare.compare_folders(spark, str(a), str(b)))
    assert [r[3] for r in by_line] == ["Y", "N", "Y", "N", "Y", "N"]


def test_null_texts_and_repeated_names(spark):
    left = spark.createDataFrame([("n", None), ("m", None), ("r", "a"), ("r", "b"), ("s", "a"), ("s", "a")], "file_name string, text string")
    right = spark.createDataFrame([("n", None), ("m", "x"), ("r", "b"), ("r", "a"), ("s", "a")], "file_name string, text string")
    got = compare.compare_datasets(left, right)
    assert rows(got) == [("m", "Y", "Y", "N"), ("n", "Y", "Y", "Y"), ("r", "Y", "Y", "Y"), ("s", "Y", "Y", "N")]
