"""Command line flows, run in-process on the test session."""

from millrace.__main__ import main
from tests.test_merge import PARTS_CSV


def test_cli_merge_rows_and_compare(spark, tmp_path, capsys):
    (tmp_path / "in.csv").write_text(PARTS_CSV.replace("sku", "id"))
    assert main(["merge-rows", "--input", str(tmp_path / "in.csv"), "--output", str(tmp_path / "out")]) == 0
    back = spark.read.option("header", True).csv(str(tmp_path / "out")).orderBy("id")
    assert [tuple(r) for r in back.collect()][1] == ("k9", "washer", "B2", "zinc")
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir()
    b.mkdir()
    (a / "x.txt").write_text("a b\n")
    (b / "x.txt").write_text("ab\n\n")
    main(["compare", "--folder1", str(a), "--folder2", str(b), "--by-line"])
    assert "|x.txt    |Y         |Y         |Y            |" in capsys.readouterr().out


def test_cli_run_sql_and_export(spark, tmp_path, capsys):
    script = tmp_path / "s.sql"
    script.write_text("-- @label: nums\nSELECT id FROM range(10)\n-- @label: big\nSELECT count(*) AS n FROM nums WHERE id >= :lo\n")
    main(["run-sql", "--script", str(script), "--param", "lo=7"])
    assert "|3  |" in capsys.readouterr().out
    spark.range(1, 11).write.parquet(str(tmp_path / "src"))
    main(["export", "--source", str(tmp_path / "src"), "--out", str(tmp_path / "exp"), "--chunks", "3",
          "--order-by", "id", "--naming", "part"])
    out = capsys.readouterr().out
    assert "part_1.csv" in out and "part_3.csv" in out
