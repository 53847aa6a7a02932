from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from runlens.plans.sql import run_script, run_sql
from tests.conftest import rows


def test_values_are_bound_not_spliced(spark):
    text = "it's; DROP -- \"x\""
    row = run_sql(spark, "SELECT concat(:a, ' in ', :b) AS c", {"a": text, "b": 5}).first()
    assert row.c == f"{text} in 5"


def test_concat_with_null_is_null(spark):
    assert run_sql(spark, "SELECT concat('a', :b) AS c", {"b": None}).first().c is None


def test_names_as_parameters(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    df = run_sql(spark, "SELECT IDENTIFIER(:c) AS n FROM IDENTIFIER(:t)", {"c": "id", "t": "numbers"})
    assert rows(df) == [(0,), (1,), (2,)]


def test_defaults_and_missing_names(spark):
    text = "SELECT :sep AS sep, :note AS note"
    defaults, optional = {"sep": "\t"}, ("note",)
    assert rows(run_sql(spark, text, {}, defaults, optional)) == [("\t", "")]
    assert rows(run_sql(spark, text, {"sep": ""}, defaults, optional)) == [("\t", "")]
    assert rows(run_sql(spark, text, {"sep": ",", "note": "n"}, defaults, optional)) == [(",", "n")]
    with pytest.raises(AnalysisException, match="UNBOUND_SQL_PARAMETER"):
        run_sql(spark, text, {"sep": ","})


def test_statements_share_a_session(spark):
    run = run_script(
        spark,
        [
            "CREATE OR REPLACE TEMP VIEW a AS SELECT 1 AS x",
            "CREATE OR REPLACE TEMP VIEW b AS SELECT x + 1 AS y FROM a",
            "SELECT y + :more AS z FROM b",
        ],
        {"more": 5},
    )
    assert rows(run.last) == [(7,)]
    assert rows(run.status) == [(0, "ok", None), (1, "ok", None), (2, "ok", None)]


@pytest.mark.parametrize(
    "bad,error",
    [
        ("SELECT nope FROM range(3)", "UNRESOLVED_COLUMN"),
        ("SELEC 1", "PARSE_SYNTAX_ERROR"),
        ("SELECT 1 / (id - 2) FROM range(5)", "DIVIDE_BY_ZERO"),
    ],
)
def test_stops_at_the_first_failure(spark, bad, error):
    run = run_script(spark, ["SELECT 1 AS a", bad, "CREATE OR REPLACE TEMP VIEW never AS SELECT 1"])
    status = rows(run.status)
    assert [s[1] for s in status] == ["ok", "failed", "not_run"]
    assert status[1][2].startswith(error)
    assert len(run.results) == 1
    assert not spark.catalog.tableExists("never")


def test_without_execution_only_analysis_counts(spark):
    run = run_script(spark, ["SELECT 1 / 0 AS a"], execute=False)
    assert rows(run.status) == [(0, "ok", None)]


def test_functions_as_statements(spark):
    def register(session):
        session.range(4).createOrReplaceTempView("four")

    run = run_script(spark, [register, lambda session: session.table("four"), "SELECT count(*) AS n FROM four"])
    assert run.results[0] is None and run.results[1].count() == 4 and rows(run.last) == [(4,)]

    def fail(session):
        raise ValueError("no")

    assert rows(run_script(spark, [fail, "SELECT 1"]).status) == [(0, "failed", "ValueError"), (1, "not_run", None)]
