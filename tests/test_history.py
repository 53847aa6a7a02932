from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from runlens.operators import outcome, verify
from runlens.operators.history import run_verdicts
from runlens.operators import skew
from runlens.operators.skew import HotKeys, hot_keys, key_sketch, keys_of_sketch, merged_sketches, split_join
from runlens.plans.queries import QUERIES
from tests.conftest import rows
from tests.test_queries import SF_DIR, needs_data

T0 = datetime(2024, 1, 1)


def history(spark, seed, n=400):
    """Runs of which one has a third of the observations and log rows, and one application a third of the runs."""
    rng = random.Random(seed)
    at = lambda s: T0 + timedelta(seconds=s)
    some_run = lambda: 0 if rng.random() < 0.34 else rng.choice([None, *range(1, 70)])
    runs = []
    for i in range(60):
        app = 7 if rng.random() < 0.34 else rng.choice([None, i, i % 10])
        runs.append((i, app, rng.choice([None, "spark", "yarn", "mesos"]), rng.choice([None, True, False])))
    runs.append((None, 7, "spark", True))
    starts = [(i, at(rng.randint(0, 50))) for i in range(65) if i % 9]
    states = ["running", "starting", "idle"] * 4 + ["success"] * 3 + ["dead", None]
    obs = [(some_run(), i, rng.choice([None, *map(at, range(0, 400, 7))]), rng.choice(states)) for i in range(n)]
    jobs = [(rng.choice([None, *range(60)]), i, i, rng.choice(["SUCCEEDED"] * 9 + ["FAILED", None]), rng.choice([None] * 30 + ["malformed"])) for i in range(150)]
    final = [(rng.choice([None, *range(50)]), rng.choice(["SUCCEEDED", "SUCCEEDED", "KILLED", None])) for _ in range(50)]
    logs = [(some_run(), "x") for _ in range(n)]
    make = spark.createDataFrame
    return {
        "runs": make(runs, "run_id BIGINT, app_id BIGINT, verify_in STRING, spill_logs BOOLEAN"),
        "starts": make(starts, "run_id BIGINT, start_ts TIMESTAMP"),
        "obs": make(obs, "run_id BIGINT, event_id BIGINT, ts TIMESTAMP, state STRING"),
        "app_jobs": make(jobs, "app_id BIGINT, ord INT, job_id BIGINT, status STRING, error STRING"),
        "app_final": make(final, "app_id BIGINT, final_status STRING"),
        "logs": make(logs, "run_id BIGINT, line STRING"),
    }


def step_by_step(runs, starts, obs, app_jobs, app_final, logs, timeout):
    """The same by the operators for single steps."""
    own = outcome.run_outcome(obs, starts, timeout).select("run_id", F.col("outcome").alias("own"))
    known = runs.filter("run_id IS NOT NULL").join(own, "run_id", "left").fillna({"own": "pending"})
    result = verify.reconcile(known, app_jobs, app_final)
    kept = verify.select_logs(result, logs).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return result.join(kept, "run_id", "left").select("run_id", "own", "outcome", "reason", "bad_status", "n_lines")


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("sizes", [{"hot_part": 1.0, "min_hot_rows": 10**9}, {"hot_part": 0.05, "min_hot_rows": 2}], ids=["plain", "split"])
def test_verdicts_equal_single_steps(spark, seed, sizes):
    made = history(spark, seed)
    found = rows(run_verdicts(**made, timeout_sec=120, **sizes))
    assert len(found) == 60
    assert found == rows(step_by_step(**made, timeout=120))
    assert len({r[3] for r in found}) > 4
    hot = {
        "hot_runs": HotKeys.find(made["obs"], key="run_id", **sizes),
        "hot_apps": HotKeys.find(made["runs"], key="app_id", **sizes),
    }
    assert bool(hot["hot_runs"].keys) == (sizes["min_hot_rows"] == 2)
    assert rows(run_verdicts(**made, timeout_sec=120, **hot)) == found


def test_verdicts_of_nothing(spark):
    made = {name: df.limit(0) for name, df in history(spark, 1).items()}
    assert run_verdicts(**made).count() == 0
    alone = made | {"runs": spark.createDataFrame([(1, None, None, None)], made["runs"].schema)}
    assert rows(run_verdicts(**alone)) == [(1, "pending", "pending", None, None, None)]


def test_verdicts_of_repeated_runs(spark):
    made = history(spark, 1)
    twice = made | {"runs": made["runs"].union(made["runs"])}
    assert rows(run_verdicts(**twice, timeout_sec=120)) == rows(run_verdicts(**made, timeout_sec=120))


def scans_of(df) -> int:
    return df._jdf.queryExecution().sparkPlan().toString().count("FileScan")


@needs_data
def test_whole_history_takes_few_scans(spark):
    result = QUERIES["end_to_end"](spark, SF_DIR)
    assert scans_of(result) <= 10
    assert result.count() == spark.read.parquet(f"{SF_DIR}/orders.parquet").count()


def test_sketches_merge(spark):
    one = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    two = spark.range(1000).select(F.when(F.col("id") % 2 == 0, -2).otherwise(F.col("id") + 5000).alias("k"))
    merged = merged_sketches(key_sketch(one, "k"), key_sketch(two, "k"))
    both = hot_keys(one.union(two), "k", 0.04, 10)
    assert rows(keys_of_sketch(merged, "k", 0.04, 10).select("k", "n_salts")) == rows(both) != []
    found = HotKeys.find(one, two, key="k", hot_part=0.04, min_hot_rows=10)
    assert set(found.keys) == set(rows(both))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_with_shared_hot_keys(spark, how, tmp_path):
    """Keys are found once, with one more read of the key column, for any number of joins."""
    made = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    made.write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = rows(left.join(right, "k", how))
    for sizes in ({"hot_part": 0.05, "min_hot_rows": 5}, {}):
        hot = HotKeys.find(left, key="k", **sizes)
        joined = split_join(left, right, "k", how, hot=hot)
        assert rows(joined) == plain
        again = split_join(joined, right.withColumnRenamed("v", "w"), "k", how, hot=hot)
        assert scans_of(again) == 1
        assert rows(again) == rows(left.join(right, "k", how).join(right.withColumnRenamed("v", "w"), "k", how))


def test_rows_without_a_key_are_spread_where_no_key_is_hot(spark):
    left = spark.range(4000).select(F.when(F.col("id") < 10, F.col("id")).alias("k"), "id")
    right = spark.range(20).groupBy(F.col("id").alias("k")).agg(F.max("id").alias("v"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = split_join(left, right, "k", hot=HotKeys.find(left, key="k")).hint("merge")
        sizes = joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
        found = rows(joined.filter("k IS NOT NULL").select("k", "v"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sum(r.n for r in sizes) == 4000 and max(r.n for r in sizes) < 2000
    assert found == [(i, i) for i in range(10)]


def test_a_join_has_as_many_tasks_as_its_rows_need(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    left = spark.range(1000).withColumnRenamed("id", "k")
    joined = split_join(left, left.withColumn("v", F.col("k")), "k", hot=HotKeys.find(left, key="k"))
    assert joined.rdd.getNumPartitions() == 10
    assert joined.filter("k = v").count() == 1000
