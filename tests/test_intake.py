"""Streaming file intake: latest row per key, restart safety, new files."""

from pyspark.sql import functions as F

from millrace.streaming import intake
from tests.conftest import rows


def test_ingest_restart_and_new_files(spark, tmp_path):
    src, state, arch, ck = (str(tmp_path / n) for n in ("in", "state", "archive", "ck"))
    ev = spark.range(0, 60).select((F.col("id") % 5).alias("user_id"), F.col("id").alias("ts"),
                                   (F.col("id") * 10).alias("value"))
    ev.filter("ts < 40").repartition(4).write.parquet(src)
    args = dict(state_dir=state, archive_dir=arch, checkpoint_dir=ck, keys=["user_id"],
                order_by=["ts"], max_files_per_trigger=2)
    intake.ingest_files(spark, src, ev.schema, **args)
    first = rows(intake.current_state(spark, state, ["user_id"], ["ts"]), "user_id", "ts")
    assert first == [(u, 35 + u) for u in range(5)]
    archived = spark.read.parquet(arch).count()
    assert archived == 40
    q = intake.ingest_files(spark, src, ev.schema, **args)  # restart: nothing new
    assert q.lastProgress is None or q.lastProgress["numInputRows"] == 0
    assert spark.read.parquet(arch).count() == 40
    ev.filter("ts >= 40").repartition(2).write.mode("append").parquet(src)
    intake.ingest_files(spark, src, ev.schema, **args)
    assert rows(intake.current_state(spark, state, ["user_id"], ["ts"]), "user_id", "ts") == \
        [(u, 55 + u) for u in range(5)]
    assert spark.read.parquet(arch).count() == 60


def test_pending_files(spark):
    listing = spark.createDataFrame([("a.csv",), ("b.csv",), ("c.csv",)], "path string")
    ledger = spark.createDataFrame([("b.csv",)], "path string")
    assert rows(intake.pending_files(listing, ledger)) == [("a.csv",), ("c.csv",)]


def test_csv_intake_rejects_and_ledger(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("user_id,ts,value\n1,1,10\n2,2,20\n")
    (src / "b.csv").write_text("user_id,ts,value\n1,5,50\nnot-a-number,6,60\n")
    schema = "user_id long, ts long, value long"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    out = {n: str(tmp_path / n) for n in ("state", "rej", "ledger", "ck")}
    intake.ingest_files(spark, str(src), st, fmt="csv", options={"header": "true"},
                        state_dir=out["state"], archive_dir=None, checkpoint_dir=out["ck"],
                        keys=["user_id"], order_by=["ts"], reject_dir=out["rej"], ledger_dir=out["ledger"])
    assert rows(intake.current_state(spark, out["state"], ["user_id"], ["ts"])) == [(1, 5, 50), (2, 2, 20)]
    rej = spark.read.parquet(out["rej"]).collect()
    assert len(rej) == 1 and rej[0]["source_file"].endswith("b.csv")
    ledger = spark.read.parquet(out["ledger"]).select("path")
    assert ledger.count() == 2
    listing = ledger.unionByName(spark.createDataFrame([("file:///new.csv",)], "path string"))
    assert rows(intake.pending_files(listing, ledger)) == [("file:///new.csv",)]
