from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from runlens.operators import scripts, verify
from tests.conftest import rows

SPLIT = {"hot_part": 0.08, "min_hot_rows": 2}
PLAIN = {"hot_part": 1.0, "min_hot_rows": 10**9}
BOTH = pytest.mark.parametrize("sizes", [PLAIN, SPLIT], ids=["plain", "split"])

RUNS = [
    # run_id, app_id, state, verify_in, spill_logs
    (1, 10, "success", None, None),
    (2, 10, "success", "spark", False),
    (3, 11, "success", "spark", False),
    (4, 12, "success", "spark", True),
    (5, None, "success", "spark", False),
    (6, 10, "success", "yarn", False),
    (7, 11, "success", "yarn", False),
    (8, 12, "success", "yarn", False),
    (9, 10, "dead", "spark", False),
    (10, 10, "running", "yarn", False),
    (11, 10, "success", "mesos", False),
    (12, None, "success", None, False),
]
JOBS = [(10, 1, 1, "SUCCEEDED"), (10, 2, 2, "SUCCEEDED"), (11, 2, 2, "FAILED"), (11, 1, 1, "SUCCEEDED"), (11, 3, 3, "KILLED"), (None, 1, 1, "FAILED")]
FINAL = [(10, "SUCCEEDED"), (11, "NOTGOOD"), (None, "SUCCEEDED")]


@pytest.fixture
def tables(spark):
    return (
        spark.createDataFrame(
            RUNS, "run_id BIGINT, app_id BIGINT, state STRING, verify_in STRING, spill_logs BOOLEAN"
        ),
        spark.createDataFrame(JOBS, "app_id BIGINT, ord BIGINT, job_id BIGINT, status STRING"),
        spark.createDataFrame(FINAL, "app_id BIGINT, final_status STRING"),
    )


@BOTH
def test_verify_jobs(tables, sizes):
    runs, jobs, _ = tables
    found = verify.verify_jobs(runs.select("run_id", "app_id"), jobs, **sizes)
    by_run = {r.run_id: (r.verdict, r.bad_job_id, r.bad_status) for r in found.collect()}
    assert len(by_run) == len(RUNS)
    assert by_run[2] == ("passed", None, None)
    assert by_run[3] == ("failed", 2, "FAILED")
    assert by_run[4] == ("passed", None, None)  # an app without jobs passes
    assert by_run[5] == ("no_app_id", None, None)


def test_null_job_status_is_bad(spark, tables):
    jobs = spark.createDataFrame([(10, 1, 1, None)], "app_id BIGINT, ord BIGINT, job_id BIGINT, status STRING")
    found = verify.verify_jobs(tables[0].filter("run_id = 2"), jobs).first()
    assert (found.verdict, found.bad_job_id, found.bad_status) == ("failed", 1, None)


@BOTH
def test_verify_final(tables, sizes):
    runs, _, final = tables
    found = verify.verify_final(runs.select("run_id", "app_id"), final, **sizes)
    by_run = {r.run_id: (r.verdict, r.final_status) for r in found.collect()}
    assert by_run[6] == ("passed", "SUCCEEDED")
    assert by_run[7] == ("failed", "NOTGOOD")
    assert by_run[8] == ("malformed", None)
    assert by_run[5] == ("no_app_id", None)


EXPECTED = {
    1: ("success", None, None),
    2: ("success", None, None),
    3: ("failed", "bad_job", "FAILED"),
    4: ("success", None, None),
    5: ("failed", "no_app_id", None),
    6: ("success", None, None),
    7: ("failed", "bad_final_status", "NOTGOOD"),
    8: ("failed", "no_final_status", None),
    9: ("failed", "run_failed", None),
    10: ("pending", None, None),
    11: ("failed", "unknown_verifier", None),
    12: ("success", None, None),
}


@BOTH
def test_reconcile(tables, sizes):
    found = verify.reconcile(*tables, **sizes)
    assert {r.run_id: (r.outcome, r.reason, r.bad_status) for r in found.collect()} == EXPECTED


def test_disagreements(tables):
    assert rows(verify.disagreements(verify.reconcile(*tables))) == sorted(
        [
            ("mesos", "unknown_verifier", None, 1),
            ("spark", "bad_job", "FAILED", 1),
            ("spark", "no_app_id", None, 1),
            ("yarn", "bad_final_status", "NOTGOOD", 1),
            ("yarn", "no_final_status", None, 1),
        ],
        key=repr,
    )


@BOTH
@pytest.mark.parametrize("by_default", [True, False])
def test_select_logs(spark, tables, by_default, sizes):
    reconciled = verify.reconcile(*tables)
    log = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit(3)).otherwise(F.col("id") % 15).cast("bigint").alias("run_id"),
        F.col("id").alias("pos"),
    )
    wanted = {3, 4, 5, 7, 8, 9, 11} | ({1} if by_default else set())
    kept = verify.select_logs(reconciled, log, by_default, **sizes)
    dropped = verify.select_logs(reconciled, log, by_default, kept=False, **sizes)
    assert rows(kept) == rows(log.filter(F.col("run_id").isin(*wanted)))
    assert rows(dropped) == rows(log.filter(~F.col("run_id").isin(*wanted)))


def test_run_that_was_never_created_keeps_no_logs(spark):
    runs = spark.createDataFrame([(None, "failed", True)], "run_id BIGINT, outcome STRING, spill_logs BOOLEAN")
    log = spark.createDataFrame([(None, 1)], "run_id BIGINT, pos BIGINT")
    assert verify.select_logs(runs, log).count() == 0
    assert verify.select_logs(runs, log, kept=False).count() == 1


DDL = "session_id BIGINT, pos BIGINT, state STRING, status STRING"


def test_second_statement_fails(spark):
    df = spark.createDataFrame(
        [(1, 0, "available", "ok"), (1, 1, "available", "error"), (1, 2, "available", "ok"),
         (2, 0, "available", "ok"), (2, 1, "running", None),
         (3, 0, "paused", "ok"), (3, 1, "available", "ok"),
         (4, 0, "available", None), (4, 1, "available", "ok")],
        DDL,
    )
    found = scripts.fail_fast(df).select("session_id", "pos", "run_class")
    assert rows(found) == [
        (1, 0, "success"), (1, 1, "failed"), (1, 2, "not_run"),
        (2, 0, "success"), (2, 1, "pending"),
        (3, 0, "failed"), (3, 1, "not_run"),
        (4, 0, "malformed"), (4, 1, "not_run"),
    ]
    assert rows(scripts.script_summary(df)) == [
        (1, 3, 2, False, 1), (2, 2, 2, False, None), (3, 2, 1, False, 0), (4, 2, 1, False, 0),
    ]


@BOTH
def test_fail_fast_with_a_long_session(spark, sizes):
    rng = random.Random(9)
    data, expected = [], []
    for session in range(6):
        n = 400 if session == 0 else 40
        stop = rng.choice([None, n // 2, 0])
        for pos in range(n):
            failed = stop is not None and (pos == stop or (pos > stop and rng.random() < 0.5))
            data.append((session, pos, "available", "error" if failed else "ok"))
            kind = "failed" if failed else "success"
            expected.append((session, pos, "not_run" if stop is not None and pos > stop else kind))
    rng.shuffle(data)
    found = scripts.fail_fast(spark.createDataFrame(data, DDL), **sizes)
    assert rows(found.select("session_id", "pos", "run_class")) == sorted(expected, key=repr)
