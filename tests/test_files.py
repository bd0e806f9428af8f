"""CSV text/typed reads, listings, schema cleaning and inference, DDL, rejects."""

import os

import pytest

from millrace.operators import schema
from millrace.sources import files, tables
from tests.conftest import rows


def test_csv_text_empty_short_long(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b,c\n1,,x\n2,y\n3,z,w,extra\n,,\n")
    df = files.read_csv_text(spark, str(p), keep_corrupt=True)
    got = {r["a"]: (r["b"], r["c"], r["_corrupt_record"] is not None) for r in df.collect()}
    assert got["1"] == ("", "x", False)        # empty cell is '' not null
    assert got["2"] == ("y", None, True)       # short row: missing cell null, flagged
    assert got["3"][2] is True                 # long row flagged
    assert got[""] == ("", "", False)


def test_list_and_count_files_brute_force(spark, tmp_path):
    root = tmp_path / "tree"
    for rel in ["a.csv", "b.CSV", "x.csv.done", "sub/c.csv", "sub/deep/d.txt", "sub/e", "f.Txt", "sub/empty.csv"]:
        os.makedirs(root / os.path.dirname(rel), exist_ok=True)
        (root / rel).write_text("" if "empty" in rel else "x")
    counts = dict(rows(files.count_files(spark, str(root))))
    brute = {}
    for d, _, fs in os.walk(root):
        for f in fs:
            ext = f.rsplit(".", 1)[1].lower() if "." in f else ""
            brute[ext] = brute.get(ext, 0) + 1
    assert counts == brute
    assert rows(files.count_files(spark, str(root), "csv")) == [("csv", 4)]
    listed = sorted(r["file_name"] for r in files.list_files(spark, str(root), glob="*.csv").collect())
    assert listed == ["a.csv", "c.csv", "empty.csv"]
    top = sorted(r["relative_path"] for r in files.list_files(spark, str(root), recursive=False).collect())
    assert top == ["a.csv", "b.CSV", "f.Txt", "x.csv.done"]
    with pytest.raises(Exception):
        files.list_files(spark, str(tmp_path / "missing")).collect()


def test_clean_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a b` int, `c-d` int, `e.f` int")
    assert schema.clean_names(df).columns == ["a_b", "c_d", "e_f"]
    with pytest.raises(ValueError):
        schema.clean_names(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


def test_infer_policies(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("id,name,value,timestamp,flag,n\n7,oak,3.25,2021-05-06,true,\n8,elm,4.0,2021-05-07,false,12\n")
    df = files.read_csv_typed(spark, str(p))
    def types(policy):
        return [r["data_type"] for r in schema.infer_ddl(df, policy).orderBy("ordinal").collect()]
    assert types("int64") == ["BIGINT", "STRING", "DOUBLE", "STRING", "BOOLEAN", "BIGINT"]
    assert types("int32") == ["INT", "STRING", "DOUBLE", "STRING", "BOOLEAN", "INT"]
    assert types("int64_ts")[3] == "TIMESTAMP"


def test_build_ddl_and_types():
    cols = [("user_id", "BIGINT"), ("user_name", "STRING"), ("email", "VARCHAR(255)"),
            ("registration_date", "DATE"), ("last_login_ts", "TIMESTAMP"), ("is_active", "BOOLEAN"),
            ("balance", "DECIMAL(10,2)")]
    ddl = tables.build_ddl("db.users", cols, fmt="csv", delimiter="|", location="/data/users",
                           comment="user table")
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS `db`.`users` (")
    assert "OPTIONS ('sep' = '|')" in ddl and "LOCATION '/data/users'" in ddl
    assert tables.schema_ddl(cols).count("STRING") == 2


def test_ddl_runs_and_schema_parses(spark, tmp_path):
    cols = [("product_id", "INT"), ("product_name", "STRING"), ("price", "DOUBLE")]
    tables.create_table(spark, "ddl_products", cols, replace=True, fmt="orc",
                        location=str(tmp_path / "orc"))
    assert spark.table("ddl_products").columns == ["product_id", "product_name", "price"]
    df = spark.createDataFrame([], tables.schema_ddl(cols + [("email", "VARCHAR(20)")]))
    assert df.schema["email"].dataType.simpleString() == "string"


def test_split_rejects(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "3"), ("3", ""), ("4", None), ("5", "1e2")],
                               "id string, v string")
    good, bad = schema.split_rejects(df, {"id": "int", "v": "double"})
    assert rows(good) == [(1, 2.5), (3, None), (4, None), (5, 100.0)]
    assert rows(bad) == [("x", "3", "id")]


def test_conform(spark):
    df = spark.createDataFrame([(1, "a", 9)], "ID int, name string, extra int")
    out = schema.conform(df, "id BIGINT, name STRING, missing DOUBLE")
    assert out.columns == ["id", "name", "missing"] and rows(out) == [(1, "a", None)]


def test_write_files_rejects_format(spark, tmp_path):
    with pytest.raises(ValueError):
        files.write_files(spark.range(1), str(tmp_path / "x"), "xml")


def test_csv_keeps_microseconds(spark, tmp_path):
    df = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.123456' AS n, "
                   "timestamp'2024-01-02 03:04:05.654321' AS l")
    files.write_csv(df, str(tmp_path / "t"))
    back = spark.read.options(**files.CSV_TIME_OPTIONS).option("header", True) \
        .schema("n timestamp_ntz, l timestamp").csv(str(tmp_path / "t"))
    assert back.collect() == df.collect()


def test_load_csv_to_table_with_rejects(spark, tmp_path):
    from millrace.plans import loads
    good = tmp_path / "good.csv"
    good.write_text("user id,user-name,score\n1,ann,2.5\n2,bob,3\n")
    rep = loads.load_csv_to_table(spark, str(good), "loaded_users", location=str(tmp_path / "t1"))
    assert tuple(rep.first()) == (2, 3, "user_id,user_name,score")
    assert spark.table("loaded_users").schema.simpleString() == "struct<user_id:int,user_name:string,score:double>"
    spark.sql("DROP TABLE IF EXISTS loaded_rejects")
    spark.createDataFrame([], "user_id string, user_name string, score string, _reject_reason string") \
        .write.option("path", str(tmp_path / "rej")).saveAsTable("loaded_rejects")
    bad = tmp_path / "bad.csv"
    # an integer beyond INT under the int32 policy cannot load: it becomes a reject
    bad.write_text("user id,user-name,score\n1,ann,2.5\n3000000000,big,1\n")
    rep = loads.load_csv_to_table(spark, str(bad), "loaded_users2", location=str(tmp_path / "t2"),
                                  reject_table="loaded_rejects")
    assert rep.first()["row_count"] == 1
    assert rows(spark.table("loaded_rejects")) == [("3000000000", "big", "1", "user_id")]


def test_csv_hard_cells_round_trip(spark, tmp_path):
    cells = ['a "quoted" word, then more', " padded ", "two\nlines", '"', "", "plain"]
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(cells)], "id string, cell string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv_text(spark, str(tmp_path / "out"))
    assert [r["cell"] for r in back.orderBy("id").collect()] == cells
