from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from runlens.functions.replies import statement_states
from runlens.functions.states import SESSION, STATEMENT_REPLY
from runlens.operators import outcome
from runlens.operators.skew import hot_keys, split_join
from tests.conftest import rows

T0 = datetime(2024, 1, 1)
PENDING = ["not_started", "starting", "running", "busy"]
# Tiny thresholds, so that the small tables of a test have hot keys.
SPLIT = {"hot_part": 0.08, "min_hot_rows": 2}
PLAIN = {"hot_part": 1.0, "min_hot_rows": 10**9}


def kind(state):
    return "pending" if state in PENDING else "success" if state == "success" else "failed"


def observe(seed: int, n: int = 400, terminal: float = 0.05):
    """Observations of 12 runs, run 0 holding a third of them."""
    rng = random.Random(seed)
    found = []
    for event_id in range(n):
        run = 0 if rng.random() < 0.34 else rng.randrange(1, 12)
        state = rng.choice(["success", "dead", None]) if rng.random() < terminal else rng.choice(PENDING)
        found.append((event_id, run, T0 + timedelta(seconds=rng.randrange(0, 120)), state))
    return found


def frames(spark, obs):
    df = spark.createDataFrame(obs, "event_id BIGINT, run_id BIGINT, ts TIMESTAMP_NTZ, state STRING")
    return df, outcome.run_starts(df)


def by_run(obs):
    runs = {}
    for event_id, run, ts, state in obs:
        runs.setdefault(run, []).append((ts, event_id, state))
    return {run: sorted(seen, key=lambda o: o[:2]) for run, seen in runs.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_first_terminal(spark, seed):
    obs = observe(seed)
    expected = []
    for run, seen in by_run(obs).items():
        first = next((o for o in seen if kind(o[2]) != "pending"), None)
        expected.append((run, kind(first[2]), first[2], first[0], first[1]) if first else (run, "pending", None, None, None))
    assert rows(outcome.first_terminal(frames(spark, obs)[0])) == sorted(expected, key=repr)


@pytest.mark.parametrize("sizes", [PLAIN, SPLIT], ids=["plain", "split"])
@pytest.mark.parametrize("timeout", [5, 30, 500])
def test_run_outcome(spark, timeout, sizes):
    obs = observe(3, terminal=0.02)
    df, starts = frames(spark, obs)
    expected = []
    for run, seen in by_run(obs).items():
        limit = seen[0][0] + timedelta(seconds=timeout)
        first = next((o for o in seen if kind(o[2]) != "pending" or o[0] > limit), None)
        if first is None:
            expected.append((run, "pending", None, None))
        else:
            found = kind(first[2])
            expected.append((run, "timeout" if found == "pending" else found, first[0], first[2]))
    assert rows(outcome.run_outcome(df, starts, timeout, **sizes)) == sorted(expected, key=repr)


@pytest.mark.parametrize("sizes", [PLAIN, SPLIT], ids=["plain", "split"])
@pytest.mark.parametrize("timeout", [5, 30, 500])
def test_run_outcome_at_deadline(spark, timeout, sizes):
    obs = observe(4, terminal=0.02)
    df, starts = frames(spark, obs)
    now = max(o[2] for o in obs)
    expected = []
    for run, seen in by_run(obs).items():
        limit = seen[0][0] + timedelta(seconds=timeout)
        first = next((o for o in seen if kind(o[2]) != "pending" and o[0] <= limit), None)
        if first:
            expected.append((run, kind(first[2]), first[0], first[2]))
        else:
            expected.append((run, "timeout", limit, None) if limit < now else (run, "pending", None, None))
    found = outcome.run_outcome_at_deadline(df, starts, timeout, **sizes)
    assert rows(found) == sorted(expected, key=repr)


def test_late_success_counts_only_without_a_pending_row_past_the_timeout(spark):
    at = lambda s: T0 + timedelta(seconds=s)
    obs = [
        (1, 1, at(0), "running"), (2, 1, at(50), "success"),
        (3, 2, at(0), "running"), (4, 2, at(40), "running"), (5, 2, at(50), "success"),
        (6, 3, at(0), "running"), (7, 3, at(30), "running"), (8, 3, at(31), "success"),
    ]
    df, starts = frames(spark, obs)
    assert [r[1] for r in rows(outcome.run_outcome(df, starts, 30))] == ["success", "timeout", "success"]
    strict = outcome.run_outcome_at_deadline(df, starts, 30)
    assert [r[1] for r in rows(strict)] == ["timeout", "timeout", "timeout"]


def test_runs_without_observations_are_pending(spark):
    df, _ = frames(spark, [(1, 1, T0, "success")])
    runs = spark.createDataFrame([(1, T0), (2, T0)], "run_id BIGINT, start_ts TIMESTAMP_NTZ")
    assert [r[:2] for r in rows(outcome.run_outcome(df, runs, 5))] == [(1, "success"), (2, "pending")]


@pytest.mark.parametrize("sizes", [PLAIN, SPLIT], ids=["plain", "split"])
def test_polls_until_done(spark, sizes):
    obs = observe(5, terminal=0.02)
    expected = []
    for run, seen in by_run(obs).items():
        done = next((i for i, o in enumerate(seen) if kind(o[2]) != "pending"), None)
        expected.append((run, len(seen) if done is None else done + 1, done is not None))
    assert rows(outcome.polls_until_done(frames(spark, obs)[0], **sizes)) == sorted(expected, key=repr)


@pytest.mark.parametrize("sizes", [PLAIN, SPLIT], ids=["plain", "split"])
def test_sample_states(spark, sizes):
    obs = observe(6)
    df, starts = frames(spark, obs)
    expected = []
    for run, seen in by_run(obs).items():
        for poll in range(0, 60 // 7 + 1):
            at = seen[0][0] + timedelta(seconds=7 * poll)
            before = [o for o in seen if o[0] <= at]
            expected.append((run, poll, at, before[-1][2] if before else None))
    assert rows(outcome.sample_states(df, starts, 7, 60, **sizes)) == sorted(expected, key=repr)


def test_sampling_stops_when_a_run_has_ended(spark):
    obs = observe(7, terminal=0.1)
    df, starts = frames(spark, obs)
    expected = []
    for run, seen in by_run(obs).items():
        for poll in range(0, 60 // 7 + 1):
            at = seen[0][0] + timedelta(seconds=7 * poll)
            state = [o for o in seen if o[0] <= at][-1][2]
            expected.append((run, poll, at, state))
            if kind(state) != "pending":
                break
    found = outcome.sample_states(df, starts, 7, 60, stop_when_done=True)
    assert rows(found) == sorted(expected, key=repr)


def test_sampling_starts_before_the_first_observation(spark):
    df, _ = frames(spark, [(1, 1, T0 + timedelta(seconds=25), "running"), (2, 1, T0 - timedelta(seconds=9), "busy")])
    runs = spark.createDataFrame([(1, T0 - timedelta(seconds=10))], "run_id BIGINT, start_ts TIMESTAMP_NTZ")
    # Polled 10 s before, 10 s after and 30 s after T0.
    found = outcome.sample_states(df, runs, 20, 40)
    assert [r[3] for r in rows(found)] == [None, "busy", "running"]


def test_default_poll_count(spark):
    df, starts = frames(spark, [(1, 1, T0, "running")])
    assert outcome.sample_states(df, starts).count() == 31
    assert outcome.sample_states(df, starts, 1, 2).count() == 3


def test_first_nonempty(spark):
    data = [(1, 1, T0, ""), (2, 1, T0, "a"), (3, 1, T0, "b"), (4, 2, T0, None), (5, 2, T0, "")]
    df = spark.createDataFrame(data, "event_id BIGINT, run_id BIGINT, ts TIMESTAMP, url STRING").select(
        "event_id", "run_id", "ts", F.struct("url").alias("info")
    )
    assert rows(outcome.first_nonempty(df, "info.url", "url")) == [(1, "a"), (2, None)]


def test_hot_keys_are_found(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id"
    )
    # A third of the rows, at 30000 * 0.04 / 4 rows for each salt.
    assert rows(hot_keys(df, "k", 0.04, 10)) == [(-1, 34)]
    assert hot_keys(df, "k").count() == 0
    assert hot_keys(df.filter("id < 0"), "k", 0.04, 10).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("sizes", [PLAIN, {"hot_part": 0.04, "min_hot_rows": 5}], ids=["plain", "split"])
def test_split_join_equals_plain_join(spark, how, sizes):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1))
        .when(F.col("id") % 5 == 0, F.lit(90))
        .when(F.col("id") % 7 != 0, F.col("id") % 50)
        .alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.createDataFrame([(k, str(k)) for k in range(0, 40)] + [(None, "null")], "k BIGINT, w STRING")
    split = split_join(left, right, "k", how, **sizes)
    plain = left.join(right, "k", how)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def hot_and_null_keys(spark):
    left = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    return left, spark.range(30000).select(F.col("id").alias("k"), F.lit(True).alias("w"))


def test_no_task_gets_all_rows_of_a_hot_or_null_key(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = split_join(*hot_and_null_keys(spark), "k", "left", 0.04, 5)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30000 and max(sizes) < 30000 * 0.4
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Range (") <= 4  # two of the rows, one of the other side and one to find hot keys again
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_many_keys_just_under_a_tasks_share(spark):
    """Keys with a tenth of the rows each, fewer than a task's share of a quarter."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    left = spark.range(30000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    right = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = split_join(left, right, "k", "inner", 0.1, 5)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30000 and max(sizes) < 2 * 30000 / 4
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_rows_without_time_or_run_count_for_nothing(spark):
    obs = [(1, 1, None, "error"), (2, 1, T0, "success"), (3, None, T0, "dead"), (4, 2, None, "success")]
    df, starts = frames(spark, obs)
    assert [(r.run_id, r.outcome) for r in outcome.first_terminal(df).orderBy("run_id").collect()] == [
        (1, "success"), (2, "pending"),
    ]
    assert rows(outcome.polls_until_done(df)) == [(1, 1, True)]
    found = outcome.run_outcome(df, starts.filter("start_ts IS NOT NULL"), 60)
    assert [(r.run_id, r.outcome) for r in found.collect()] == [(1, "success")]


def test_rules_of_sessions_and_statements(spark):
    seen = [(1, 1, T0, "starting"), (2, 1, T0 + timedelta(seconds=5), "idle"), (3, 2, T0, "starting")]
    df, starts = frames(spark, seen + [(4, 2, T0 + timedelta(seconds=90), "starting")])
    found = outcome.run_outcome(df, starts, 60, SESSION)
    assert [r.outcome for r in found.orderBy("run_id").collect()] == ["ready", "timeout"]
    assert [r.outcome for r in outcome.first_terminal(df).orderBy("run_id").collect()] == ["pending"] * 2
    replies = spark.createDataFrame(
        [
            (1, 1, T0, '{"state": "waiting"}'),
            (2, 1, T0, '{"state": "available", "output": {"status": "ok"}}'),
            (3, 2, T0, '{"state": "available", "output": {"result": 1}}'),
            (4, 3, T0, '{"state": "available", "output": {"status": null}}'),
            (5, 4, T0, '{"state": "running", "output": null}'),
            (6, 5, T0, '{"state": "paused"}'),
        ],
        "event_id BIGINT, run_id BIGINT, ts TIMESTAMP_NTZ, body STRING",
    )
    found = outcome.first_terminal(statement_states(replies, "body"), STATEMENT_REPLY)
    assert [r.outcome for r in found.orderBy("run_id").collect()] == [
        "success", "malformed", "failed", "pending", "failed",
    ]
