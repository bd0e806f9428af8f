"""Types folded from all cells, loads by them, and listings with hidden names."""

import random

import pytest

from millrace.operators import lattice
from millrace.plans import sqlsteps
from millrace.plans.loads import load_csv_by_lattice
from millrace.session import unique_name
from millrace.sources import files


@pytest.mark.parametrize("cells, kind", [
    (["1", "-2", " 3 ", "", None], "int"), (["1", "3000000000"], "bigint"), (["1", "2.5"], "double"), (["1e3", ".5", "NaN"], "double"),
    (["9" * 25, "1"], "double"), (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["2024-02-29", "2023-01-01"], "date"),
    (["2023-02-29", "2023-01-01"], "string"), (["2024-01-01", "2024-01-01 10:00:00"], "timestamp"), (["2024-01-01T10:00", "x"], "string"),
    (["", None, "  "], "string"), (["1d"], "string"), (["007"], "int")])
def test_least_type_above_all_cells(spark, cells, kind):
    for order in (cells, cells[::-1]):
        frame = spark.createDataFrame([(c,) for c in order], "c string").repartition(3)
        [found] = lattice.column_types(frame)
        assert found.kind() == kind and found.cells == sum(bool(c and c.strip()) for c in cells)


def test_policies_and_tolerance(spark):
    draw = random.Random(1)
    rows = [(str(i), "n/a" if i == 999 else str(i), draw.choice(["2024-01-01", "2024-01-02 03:04:05"])) for i in range(1000)]
    found = lattice.column_types(spark.createDataFrame(rows, "a string, b string, c string"))
    assert lattice.ddl_types(found, "int32") == {"a": "INT", "b": "STRING", "c": "STRING"}
    assert lattice.ddl_types(found, "int64_ts", 0.01) == {"a": "BIGINT", "b": "BIGINT", "c": "TIMESTAMP"}
    assert [c.kind() for c in lattice.column_types(spark.createDataFrame([], "a string"))] == ["string"]


def test_load_sets_rows_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,a name\n" + "\n".join(f'{i},"n ""{i}""\nx"' for i in range(200)) + "\nlost,y\nshort\n")
    (tmp_path / "in" / "b.csv").write_text("a name,id\nz,500\n")
    good, bad = unique_name("good"), unique_name("bad")
    report = load_csv_by_lattice(spark, str(tmp_path / "in"), good, bad, tolerance=0.02, location=str(tmp_path / "t")).first()
    assert report["row_count"] == 201 and report["column_list"] == "id,a_name"
    rows = {r["id"]: r["a_name"] for r in spark.table(good).collect()}
    assert rows[7] == 'n "7"\nx' and rows[500] == "z" and dict(spark.table(good).dtypes)["id"] == "int"
    assert sorted((r["reason"], r["record"]) for r in spark.table(bad).collect()) == [("cells", "short"), ("id", '{"id":"lost","a_name":"y"}')]


def test_listing_holds_hidden_names(spark, tmp_path):
    names = ["a.csv", "_b.csv", ".c.csv", "x/_d/e.CSV", "x/y/z/f.csv.done", "_g/h", ".i/j.csv"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("12")
    (tmp_path / "empty").mkdir()
    (tmp_path / "x" / "zero.csv").write_text("")
    found = {r["path"][len(str(tmp_path)) + 1:]: r["length"] for r in files.list_tree(spark, str(tmp_path)).collect()}
    assert found == {n: 2 for n in names} | {"x/zero.csv": 0}
    assert files.list_tree(spark, f"file://{tmp_path}/empty").collect() == []
    assert files.count_files(spark, str(tmp_path), "csv", hidden=True).first()["files"] == 6


def test_scripts_split_outside_quotes_and_comments():
    script = """SELECT 'a;\\'b;', "c\\";d", `e;f` ; -- g; h
    /* i; 'j */ SELECT 1 - 2 / 3; ;
    SELECT 'open; end"""
    parts = sqlsteps.split_statements(script)
    assert parts[0] == """SELECT 'a;\\'b;', "c\\";d", `e;f`""" and parts[1].endswith("SELECT 1 - 2 / 3") and parts[2] == "SELECT 'open; end"
    assert len(parts) == 3 and sqlsteps.is_empty_sql("-- a\n /* b */ ; ") and not sqlsteps.is_empty_sql("SELECT '--'")
