from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from runlens.operators.join_files import FileInput, JoinJob, join_two_files, preview
from tests.conftest import rows

GRADES = (
    "Surname,Given,SSN,Score,Grade\n"
    'Stone,Ada,11-1,90,A\n"Hill, Jr",Bo,22-2,x,B\nLake,Cy,,70,C\nStone,Ada,11-1,60,D\nWood,Di,44-4,50,F\n'
)
GRADES_DDL = "`Last name` STRING, `First name` STRING, SSN STRING, Score INT, Grade STRING"
ADDRESSES = "11-1\t1 Main\n22-2\t2 Side\n22-2\t3 Side\n\t4 Null\n55-5\t5 None\n"
ADDRESSES_DDL = "`Person number` STRING, Address STRING"


@pytest.fixture
def files(tmp_path):
    (tmp_path / "grades.csv").write_text(GRADES)
    (tmp_path / "addresses.tsv").write_text(ADDRESSES)
    return (
        FileInput(f"file:{tmp_path}/grades.csv", "SSN", GRADES_DDL, "true", sep=","),
        FileInput(f"file:{tmp_path}/addresses.tsv", "`Person number`", ADDRESSES_DDL, "false"),
    )


EXPECTED = [
    ("Hill, Jr", "22-2", "2 Side"),
    ("Hill, Jr", "22-2", "3 Side"),
    ("Stone", "11-1", "1 Main"),
    ("Stone", "11-1", "1 Main"),
]


def test_list_and_text_select_lists_agree(spark, files):
    columns = ["file1.`Last name`", "file1.SSN", "file2.Address"]
    assert rows(JoinJob(*files, columns).run(spark)) == EXPECTED
    text = JoinJob(*files, ", ".join(columns)).run(spark)
    assert rows(text) == EXPECTED and text.columns == ["Last name", "SSN", "Address"]


def test_renames_and_expressions(spark, files):
    joined = JoinJob(
        *files, "file1.`Last name` AS LastName, concat(file2.Address, ', ', upper(file1.Grade)) AS a"
    ).run(spark)
    assert joined.columns == ["LastName", "a"]
    assert ("Hill, Jr", "2 Side, B") in rows(joined)


def test_inputs_are_registered(spark, files):
    JoinJob(*files, ["file1.SSN"]).run(spark)
    assert spark.sql("SELECT count(*) FROM file1").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM file2").first()[0] == 5


def test_unknown_column_fails_before_any_data_is_read(spark, files):
    gone = FileInput(files[0].path, "SSN", GRADES_DDL, "true", sep=",")
    for columns in (["file1.Inexistent"], "file1.Inexistent"):
        with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
            JoinJob(gone, files[1], columns).run(spark)


def test_output_is_saved(spark, files, tmp_path):
    out = str(tmp_path / "out")
    JoinJob(*files, ["file1.SSN", "file2.Address"], output_path=out, output_header="true").run(spark)
    saved = spark.read.csv(out, sep="\t", header=True)
    assert saved.columns == ["SSN", "Address"] and saved.count() == 4


def test_mixed_key_types(spark):
    numbers = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    texts = spark.createDataFrame([("1", "x"), ("01", "y"), ("abc", "z"), (None, "n")], "k STRING, w STRING")
    joined = join_two_files(numbers, texts, "k", "k", ["file1.v", "file2.w"], key_type="BIGINT")
    assert rows(joined) == [("a", "x"), ("a", "y")]
    by_sql = join_two_files(numbers, texts, "k", "k", "file1.v, file2.w", key_type="BIGINT")
    assert rows(by_sql) == rows(joined)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        join_two_files(numbers, texts, "k", "k", ["file1.v"]).collect()


def test_preview_is_a_top_k(spark):
    df = preview(spark.range(1000), order_by=[F.desc("id")])
    assert [r.id for r in df.collect()] == list(range(999, 949, -1))
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
    assert preview(spark.range(10)).count() == 10


def test_hot_key_is_split_by_adaptive_execution(spark):
    """A third of the rows share one key: the join must not run it in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        left = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
        )
        right = spark.range(60000).select(F.col("id").alias("k"), F.col("id").alias("w"))
        joined = join_two_files(left, right, "k", "k", ["file1.v", "file2.w"])
        assert joined.count() == 60000
        ran = joined.select("v")
        ran.collect()
        assert "skew=true" in ran._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
