from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from runlens.sources.delimited import clean_options, good_rows, read_checked, read_delimited, rejected_rows, write_delimited
from runlens.sources.mounts import mount
from runlens.sources.rows import id_range, literal_column, literal_rows
from tests.conftest import rows


def write(path, text: str) -> str:
    path.write_text(text)
    return str(path)


def test_declared_schema_defaults(spark, tmp_path):
    path = write(tmp_path / "a.tsv", '1\t"tab\tinside"\n2\t"say \\"hi\\""\n3\t\n')
    df = read_delimited(spark, path, "id INT, t STRING", header=False)
    assert rows(df) == [(1, "tab\tinside"), (2, 'say "hi"'), (3, None)]


def test_schema_goes_by_position_and_rows_may_be_ragged(spark, tmp_path):
    path = write(tmp_path / "a.csv", "x,y,z\n1,2,3\n4\n5,6,7,8\nbad,9,10\n")
    df = read_delimited(spark, path, "a INT, b INT, c INT", header=True, sep=",")
    assert rows(df) == [(1, 2, 3), (4, None, None), (5, 6, 7), (None, 9, 10)]
    strict = read_delimited(spark, path, "a INT, b INT, c INT", header=True, sep=",", mode="FAILFAST")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        strict.collect()


def test_quoted_names_in_schema(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Doe,Jane\n")
    df = read_delimited(spark, path, "`Last name` STRING, `First name` STRING", sep=",")
    assert df.columns == ["Last name", "First name"]


def test_inference(spark, tmp_path):
    path = write(tmp_path / "a.csv", "n,t,f\n1,a,1.5\n2,b,2.5\n")
    df = read_delimited(spark, path, header="true", sep=",", infer_schema="true")
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "string", "double"]
    plain = read_delimited(spark, path, sep=",", infer_schema="false")
    assert plain.columns == ["_c0", "_c1", "_c2"]
    assert {f.dataType.simpleString() for f in plain.schema} == {"string"}


def test_schema_wins_over_inference(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1\n")
    df = read_delimited(spark, path, "a STRING", infer_schema=True)
    assert df.schema.simpleString() == "struct<a:string>"


def test_only_wanted_columns_are_read(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1,2,3\n")
    df = read_delimited(spark, path, "a INT, b INT, c INT", sep=",").select("b")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<b:int>" in plan


def test_rejected_rows(spark, tmp_path):
    text = 'id,name,score\n1,"a,b",1.5\n2,"say \\"x\\"",\n3\nfour,d,1.5\n5,e,none\n6,f,1,extra\n7,,\n8,g\n'
    path = write(tmp_path / "a.csv", text)
    checked = read_checked(spark, path, "id INT, name STRING, score DOUBLE", header=True, sep=",")
    assert rows(good_rows(checked)) == [(1, "a,b", 1.5), (2, 'say "x"', None), (7, None, None)]
    assert rows(rejected_rows(checked)) == [
        ("bad_value", "id", "four,d,1.5"), ("bad_value", "score", "5,e,none"), ("long_row", None, "6,f,1,extra"),
        ("short_row", "name", "3"), ("short_row", "score", "8,g"),
    ]
    assert good_rows(checked).select("name").count() == 3  # whichever columns are wanted
    scans = checked.groupBy("_reason").count()._jdf.queryExecution().executedPlan().toString()
    assert scans.count("FileScan csv") == 1
    with pytest.raises(ValueError, match="_reason"):
        read_checked(spark, path, "_reason STRING")


def test_mounted_folders(spark, tmp_path):
    write(tmp_path / "a.csv", "1,x\n2,y\n")
    (tmp_path / "out").mkdir()
    root = mount(spark, "for-a-test", {"in": str(tmp_path), "/results/": f"file://{tmp_path}/out"})
    assert root == "viewfs://for-a-test"
    df = read_delimited(spark, f"{root}/in/a.csv", "n INT, t STRING", sep=",")
    write_delimited(df, f"{root}/results/copy")
    assert rows(read_delimited(spark, str(tmp_path / "out/copy"), "n INT, t STRING")) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="a b"):
        mount(spark, "a b", {"in": str(tmp_path)})


def test_empty_options_are_dropped():
    assert clean_options({"a": "", "b": None, "c": False, "d": "x"}) == {"c": False, "d": "x"}


def test_write_defaults_and_header(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n INT, t STRING")
    out = str(tmp_path / "o")
    assert write_delimited(df, out, sep="", header="", mode="")
    text = "".join(sorted(p.read_text() for p in (tmp_path / "o").glob("*.csv")))
    assert sorted(text.split("\n")) == ["", "1\ta", "2\t"]
    write_delimited(df, out, header="true")
    assert rows(read_delimited(spark, out, "n INT, t STRING", header=True)) == [(1, "a"), (2, None)]


@pytest.mark.parametrize("path", [None, ""])
def test_no_path_no_write(spark, path):
    assert write_delimited(spark.range(1), path) is False


def test_save_modes(spark, tmp_path):
    df, out = spark.range(3), str(tmp_path / "o")
    write_delimited(df, out)
    for mode in ("error", "errorifexists", "default"):
        with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
            write_delimited(df, out, mode=mode)
    write_delimited(df, out, mode="ignore")
    assert spark.read.csv(out).count() == 3
    write_delimited(df, out, mode="append")
    assert spark.read.csv(out).count() == 6
    write_delimited(df, out, mode="overwrite")
    assert spark.read.csv(out).count() == 3


def test_literals_and_range(spark):
    assert id_range(spark, 5).count() == 5
    assert rows(id_range(spark, 2, 4)) == [(2,), (3,)]
    df = literal_rows(spark, [("left", 4), ("right", 9)], ["which side", "run:7"], ["STRING", "INT"])
    assert df.columns == ["which side", "run:7"]
    assert rows(df) == [("left", 4), ("right", 9)]
    assert rows(literal_column(spark, ["a", "b"], "c")) == [("a",), ("b",)]
    assert df.agg(F.sum("`run:7`")).first()[0] == 13
