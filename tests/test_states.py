from __future__ import annotations

import pytest

from runlens.functions.states import classify_batch, classify_session, classify_statement
from runlens.operators.validate import SettingRules, split_valid, validate


def one(spark, ddl, row, column):
    return spark.createDataFrame([row], ddl).select(column).first()[0]


def classes(spark, states, function):
    df = spark.createDataFrame([(s,) for s in states], "s STRING")
    return [r[0] for r in df.select(function("s")).collect()]


def test_batch_states(spark):
    pending = ["not_started", "starting", "recovering", "idle", "running", "busy", "shutting_down"]
    assert classes(spark, pending, classify_batch) == ["pending"] * 7
    failed = ["error", "dead", "killed", "Success", "running ", "0", None, ""]
    assert classes(spark, failed, classify_batch) == ["failed"] * 8
    assert classes(spark, ["success"], classify_batch) == ["success"]


def test_session_states(spark):
    states = ["starting", "idle", "gone", "busy", None]
    assert classes(spark, states, classify_session) == ["pending", "ready", "failed", "failed", "failed"]


@pytest.mark.parametrize(
    "state,status,expected",
    [
        ("waiting", None, "pending"),
        ("running", "ok", "pending"),
        ("available", "ok", "success"),
        ("available", "partly", "failed"),
        ("available", None, "malformed"),
        ("paused", "ok", "failed"),
        (None, "ok", "failed"),
    ],
)
def test_statement_states(spark, state, status, expected):
    found = one(spark, "a STRING, b STRING", (state, status), classify_statement("a", "b"))
    assert found == expected


@pytest.mark.parametrize("present,expected", [(True, "failed"), (False, "malformed")])
def test_null_status_is_not_a_missing_one(spark, present, expected):
    ddl = "a STRING, b STRING, p BOOLEAN"
    assert one(spark, ddl, ("available", None, present), classify_statement("a", "b", "p")) == expected


DDL = "id INT, kind STRING, verify_in STRING, poke_interval INT, timeout INT"


def reasons(spark, settings):
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(settings)], DDL)
    return [r.reason for r in validate(df).orderBy("id").collect()]


def test_bad_timings(spark):
    small, above = "poll_period_too_small", "poll_period_above_timeout"
    pairs = {(-5, 60): small, (0, 60): small, (0, -1): small, (61, 60): above, (1, -1): above, (2, 1): above}
    assert reasons(spark, [("sql", None, i, t) for i, t in pairs]) == list(pairs.values())


def test_good_settings_and_order_of_checks(spark):
    settings = [
        (None, None, None, None),
        ("sparkr", "yarn", 5, 5),
        ("scala", "mesos", 0, 0),
        ("sql", "mesos", 0, 0),
        ("sql", "spark", None, 10),
    ]
    expected = [None, None, "unknown_kind", "unknown_verifier", "poll_period_above_timeout"]
    assert reasons(spark, settings) == expected


def test_split_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "sql", None, 5, 9), (2, "x", None, 5, 9)], DDL)
    valid, rejected = split_valid(df)
    assert [r.id for r in valid.collect()] == [1] and valid.columns == df.columns
    assert [(r.id, r.reason) for r in rejected.collect()] == [(2, "unknown_kind")]


def test_unchecked_columns(spark):
    rules = SettingRules(kind=None, verify_in=None, poll_period="p", timeout=None)
    df = spark.createDataFrame([(0,), (1,)], "p INT")
    assert {(r.p, r.reason) for r in validate(df, rules).collect()} == {(0, "poll_period_too_small"), (1, None)}
