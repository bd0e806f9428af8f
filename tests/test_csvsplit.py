"""CSV cut into records by many tasks, against Python's csv module."""

import csv
import random

import pytest

from millrace.sources.csvsplit import csv_records, read_csv_by_header


def cell(draw):
    kind = draw.randrange(8)
    if kind == 0:
        return ""
    if kind == 1:
        return 'say "hi"'
    if kind == 2:
        return "\n".join("line" * draw.randrange(3) for _ in range(draw.randrange(1, 6)))
    if kind == 3:
        return " pad\t"
    if kind == 4:
        return 'a,"\r\n",b'
    return "".join(draw.choice("abcé ") for _ in range(draw.randrange(12)))


def write(path, names, rows, lineterminator="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=lineterminator)
        w.writerow(names)
        w.writerows(rows)


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "4"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def as_text(rows):
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_records_of_many_splits_equal_the_csv_module(spark, tiny_splits, tmp_path, seed):
    draw = random.Random(seed)
    want = []
    for k, newline in enumerate(["\n", "\r\n"]):
        rows = [[str(i), cell(draw), cell(draw)] for i in range(150)]
        rows[70][1] = "long\n" * 400  # a cell over many splits
        write(tmp_path / f"{k}.csv", ["id", "one", "two"], rows, newline)
        want += rows
    rows, rejects = read_csv_by_header(spark, str(tmp_path), source=True)
    assert rows.columns == ["id", "one", "two", "_source_file"]
    assert as_text(rows.drop("_source_file").collect()) == as_text(want)
    assert rejects.isEmpty()
    assert rows.rdd.getNumPartitions() > 20 and rows.where("_source_file like '%/1.csv'").count() == 150


def test_columns_are_bound_by_each_files_header(spark, tmp_path):
    write(tmp_path / "a.csv", ["id", "name"], [["1", "ann"], ["2", ""]])
    write(tmp_path / "b.csv", ["name", "id", "more"], [["bob", "3", "x"], ["short", "4"], ["long", "5", "x", "y"]])
    write(tmp_path / "c.csv", ["name"], [["no id"]])
    write(tmp_path / "d.csv", ["id", "id", "name"], [["6", "7", "twice"]])
    (tmp_path / "e.csv").write_text('id,name\n8,"open\n')
    (tmp_path / "f.csv").write_text('﻿"id","na\nme",name\r\n9,"x\r\ny",z\r\n\r\n')
    (tmp_path / "g.csv").write_text("")
    (tmp_path / "h.csv").write_text("id,name")
    rows, rejects = read_csv_by_header(spark, str(tmp_path), columns=["id", "name", "more"], required=["id"])
    got = {r["id"]: (r["name"], r["more"]) for r in rows.collect()}
    assert got == {"1": ("ann", None), "2": ("", None), "3": ("bob", "x"), "9": ("z", None)}
    bad = sorted((r["file"].rsplit("/", 1)[1], r["reason"], r["record"]) for r in rejects.fillna("", ["record"]).collect())
    assert bad == [("b.csv", "cells", "long,5,x,y"), ("b.csv", "cells", "short,4"), ("c.csv", "header", "no id"),
                   ("d.csv", "header", "6,7,twice"), ("e.csv", "quotes", "")]
    every, _ = read_csv_by_header(spark, str(tmp_path / "f.csv"))
    assert every.columns == ["id", "na\nme", "name"] and tuple(every.first()) == ("9", "x\r\ny", "z")


def test_records_without_a_file_and_with_blank_lines(spark, tmp_path):
    (tmp_path / "x.csv").write_text('\n\nid\n\n"\n\n"\n\n')
    found = csv_records(spark, str(tmp_path))
    assert sorted((r["first"], r["record"]) for r in found.records.collect()) == [(False, '"\n\n"'), (True, "id")]
    (tmp_path / "empty").mkdir()
    rows, rejects = read_csv_by_header(spark, str(tmp_path / "empty"), columns=["id"])
    assert rows.collect() == [] and rejects.collect() == []
