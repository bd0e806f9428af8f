"""Snapshot tables: all or nothing, old readers, merges by bucket; intake with statuses."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources.snapshots import BUCKET, KeyedTable, SnapshotTable
from millrace.streaming.merge_intake import Intake, Target, ledger, replay
from tests.conftest import rows


def days(spark, *pairs):
    return spark.createDataFrame([(v, d) for v, d in pairs], "v int, day string")


def test_a_commit_that_stops_before_the_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    t = SnapshotTable(spark, str(tmp_path / "t"), "day")
    assert t.values() == [] and t.read(schema=days(spark).schema).collect() == []
    assert t.commit(days(spark, (1, "a"), (2, "b"), (3, "c")), replaces=["a", "b", "c"]) == 1
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            t.commit(days(spark, (9, "a")), replaces=["a", "b"])
    assert rows(t.read()) == [(1, "a"), (2, "b"), (3, "c")] and t.values() == ["a", "b", "c"]
    old = t.read()
    assert t.commit(days(spark, (4, "b"), (5, "b")), replaces=["a", "b"]) == 2  # a is emptied
    assert rows(t.read()) == [(3, "c"), (4, "b"), (5, "b")] and t.values() == ["b", "c"]
    assert rows(old) == rows(t.read(1)) == [(1, "a"), (2, "b"), (3, "c")]  # old readers keep their files
    assert rows(t.read(only=["b"])) == [(4, "b"), (5, "b")]
    assert t.vacuum(keep=1) == ["__snapshot=1/day=a", "__snapshot=1/day=b"] and rows(t.read()) == [(3, "c"), (4, "b"), (5, "b")]
    with pytest.raises(ValueError, match="not replaced"):
        t.commit(days(spark, (1, "z")), replaces=["a"])


def test_of_two_commits_the_later_one_raises(spark, tmp_path, monkeypatch):
    one, two = (SnapshotTable(spark, str(tmp_path / "t"), "day") for _ in range(2))
    stale = two.manifest()
    one.commit(days(spark, (1, "a")), replaces=["a"])
    monkeypatch.setattr(two, "manifest", lambda version=None: stale)
    with pytest.raises(RuntimeError, match="another commit"):
        two.publish(stale | {"version": 1})
    assert rows(one.read()) == [(1, "a")]


def test_a_merge_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    schema = StructType.fromDDL("id long, a string, b int")
    t = KeyedTable(spark, str(tmp_path / "t"), schema, "id", buckets=16)
    t.merge(spark.createDataFrame([(i, "x", i) for i in range(200)], schema), "update", source="s", batch=0)
    assert t.merge(spark.createDataFrame([(3, "y", None), (None, "n", 1)], schema), "coalesce", source="s", batch=1) == 2
    assert t.merge(spark.createDataFrame([(3, "again", 0)], schema), "update", source="s", batch=1) is None  # held already
    parts = t.manifest()["parts"]
    assert sorted(parts.values()) == [1] * 15 + [2] and len(schema) == 3
    got = {r["id"]: (r["a"], r["b"]) for r in t.rows().collect()}
    assert got == {i: ("y" if i == 3 else "x", i) for i in range(200)} and BUCKET not in t.rows().columns
    t.merge(spark.createDataFrame([(3, None, None), (500, "new", 1)], schema), "update")
    got = {r["id"]: (r["a"], r["b"]) for r in t.rows().where("id in (3, 500)").collect()}
    assert got == {3: (None, None), 500: ("new", 1)}


def test_intake_keeps_a_status_per_file(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    schema = StructType.fromDDL("id long, name string, seq int")
    first, second = (KeyedTable(spark, str(tmp_path / n), schema, "id", buckets=4) for n in "ab")
    intake = Intake(spark, [Target(first, "coalesce"), Target(second, "update")], order_by=["seq"],
                    ledger_dir=str(tmp_path / "ledger"), reject_dir=str(tmp_path / "rejects"))

    def run():
        intake.stream(str(landing), checkpoint_dir=str(tmp_path / "checkpoint"))

    (landing / "1.csv").write_text('seq,id,name\n1,1,"one\nline"\n2,2,\n3,2\n')
    (landing / "2.csv").write_text("id,seq\n1,5\n")
    (landing / "3.csv").write_text("name\nnobody\n")
    (landing / "4.csv").write_text('id,name,seq\n7,"open,1\n')
    (landing / "5.csv.gz").write_text("no gzip")
    (landing / "6.txt").write_text("id\n99\n")
    run()
    names = {r["path"].rsplit("/", 1)[1]: (r["status"], r["rows"], r["rejected"]) for r in ledger(spark, str(tmp_path / "ledger")).collect()}
    assert names == {"1.csv": ("partial", 2, 1), "2.csv": ("loaded", 1, 0), "3.csv": ("header", 0, 1), "4.csv": ("quotes", 0, 0),
                     "5.csv.gz": ("unreadable", 0, 0)}
    assert rows(first.rows()) == [(1, "one\nline", 5), (2, "", 2)]  # the second file knows no name
    assert rows(second.rows()) == [(1, None, 5), (2, "", 2)]
    (landing / "4.csv").write_text("id,name,seq\n7,mended,1\n")
    replay(intake, [str(landing / "4.csv")])
    assert {r["path"].rsplit("/", 1)[1]: r["status"] for r in ledger(spark, str(tmp_path / "ledger")).collect()}["4.csv"] == "loaded"
    assert first.rows().where(F.col("id") == 7).count() == second.rows().where(F.col("id") == 7).count() == 1
    version = first.manifest()["version"]
    run()  # nothing new
    assert first.manifest()["version"] == version
    assert ledger(spark, str(tmp_path / "none")).collect() == []
