from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from runlens.operators import outcome
from runlens.streaming import outcome as streaming_outcome
from runlens.streaming.outcome import (
    drain,
    first_terminal_stream,
    run_outcome_stream,
    with_rocksdb,
)
from tests.conftest import rows

T0 = datetime(2024, 1, 1)
SCHEMA = "event_id BIGINT, run_id BIGINT, ts TIMESTAMP, state STRING"


def observe(seed, n=600):
    """Rows in order of time; run 0 has a third of them."""
    rng = random.Random(seed)
    found = []
    for event_id in range(n):
        run = 0 if rng.random() < 0.34 else rng.randrange(1, 25)
        states = ["running", "starting"] * 8 + ["success", "dead", None]
        found.append((event_id, run, T0 + timedelta(seconds=event_id), rng.choice(states)))
    return found


def stream_of(spark, path, obs, files):
    """One file, and so one micro-batch, per slice of `obs`."""
    step = -(-len(obs) // files)
    for i in range(files):
        part = spark.createDataFrame(obs[i * step : (i + 1) * step], SCHEMA)
        part.coalesce(1).write.mode("append").json(str(path), timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return (
        spark.readStream.schema(SCHEMA)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("maxFilesPerTrigger", 1)
        .json(str(path))
    )


def starts_of(spark, runs, path):
    """(run_id, start_ts) as a table and as a stream."""
    runs.coalesce(1).write.parquet(str(path))
    return spark.read.parquet(str(path)), spark.readStream.schema(runs.schema).parquet(str(path))


@pytest.mark.parametrize("files", [1, 4])
def test_first_terminal_stream_equals_batch(spark, tmp_path, files):
    obs = observe(1)
    updates = drain(first_terminal_stream(stream_of(spark, tmp_path / "in", obs, files)), "update", "t1")
    last = F.max_by(F.struct("outcome", "state", "decided_ts", "event_id"), "batch_id").alias("r")
    found = updates.groupBy("run_id").agg(last).select("run_id", "r.*")
    batch = outcome.first_terminal(spark.createDataFrame(obs, SCHEMA)).filter("outcome <> 'pending'")
    assert rows(found) == rows(batch)


@pytest.mark.parametrize("files,shuffled,delay", [(1, False, "0 seconds"), (5, False, "0 seconds"), (5, True, "10 minutes")])
def test_run_outcome_stream_equals_batch(spark, tmp_path, files, shuffled, delay):
    obs, timeout = observe(2), 90
    # A late last row moves the watermark past every deadline.
    obs.append((10_000, 99, T0 + timedelta(days=1), "running"))
    # Run 50 is never observed.
    runs = outcome.run_starts(spark.createDataFrame(obs, SCHEMA))
    runs = runs.union(spark.createDataFrame([(50, T0)], "run_id BIGINT, start_ts TIMESTAMP"))
    runs, started = starts_of(spark, runs, tmp_path / "runs")
    if shuffled:
        head = obs[:-1]
        random.Random(3).shuffle(head)
        obs = head + obs[-1:]
    with with_rocksdb(spark):
        result = run_outcome_stream(stream_of(spark, tmp_path / "in", obs, files), started, timeout, delay)
        found = drain(result, "append", "t2").drop("batch_id").filter("run_id <> 99")
    batch = outcome.run_outcome_at_deadline(spark.createDataFrame(obs, SCHEMA), runs, timeout)
    batch = batch.filter("run_id <> 99")
    assert batch.filter("outcome = 'timeout'").count() > 0
    assert batch.filter("outcome = 'success'").count() > 0
    assert rows(found) == rows(batch)


def test_late_rows_and_silence(spark, tmp_path):
    at = lambda s: T0 + timedelta(seconds=s)
    obs = [
        (1, 1, at(0), "running"), (2, 2, at(0), "running"), (3, 3, at(0), "running"),
        # Second micro-batch: run 1 succeeds in time, run 3 only after its deadline.
        (4, 1, at(20), "success"), (5, 3, at(40), "success"),
        # Third: runs 1 and 3 are decided; run 2's late success comes before its report is out.
        (6, 1, at(41), "dead"), (7, 2, at(25), "success"), (8, 3, at(300), "success"),
    ]
    sizes = [3, 2, 3]
    path = tmp_path / "in"
    for n in sizes:
        part, obs = obs[:n], obs[n:]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(path))
    # Run 4 is never seen, and the starts of runs 5 and 6 come after their deadlines, which
    # is too late for the success of run 6 to be waited for but not for its report.
    starts = [[(1, T0), (2, T0), (3, T0), (4, T0)], [(7, at(35))], [(5, T0), (6, at(1))]]
    for part in starts:
        made = spark.createDataFrame(part, "run_id BIGINT, start_ts TIMESTAMP")
        made.coalesce(1).write.mode("append").parquet(str(tmp_path / "starts"))
    started = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "starts"))
    with with_rocksdb(spark):
        found = drain(run_outcome_stream(stream, started, 30), "append", "t3").drop("batch_id")
    assert rows(found) == [
        (1, "success", at(20), "success"), (2, "success", at(25), "success"), (3, "timeout", at(30), None),
        (4, "timeout", at(30), None), (5, "timeout", at(30), None), (6, "timeout", at(31), None),
        (7, "timeout", at(65), None),
    ]


def state_rows(result, mode, path):
    """Rows of state after each micro-batch, and all rows that came out."""
    out = []
    query = (
        result.writeStream.foreachBatch(lambda batch, n: out.extend((n, *r) for r in batch.collect()))
        .outputMode(mode)
        .option("checkpointLocation", str(path))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]], out


def test_first_terminal_state_is_bounded(spark, tmp_path):
    """Each hour other runs end; state holds those of the last hours only."""
    hours, per_hour = 8, 20
    obs = [
        (100 * h + i, 100 * h + i, T0 + timedelta(hours=h, minutes=i), "success") for h in range(hours) for i in range(per_hour)
    ]
    # Run 0 goes on ending, and so is remembered and not reported again.
    obs += [(5000 + h, 0, T0 + timedelta(hours=h, minutes=30), "dead") for h in range(hours)]
    obs.sort(key=lambda r: r[2])
    result = first_terminal_stream(stream_of(spark, tmp_path / "in", obs, hours), keep_sec=2 * 3600)
    with with_rocksdb(spark):
        sizes, found = state_rows(result, "update", tmp_path / "state")
    # A run has its row and a timer in two tables.
    assert max(sizes) <= 2 * 4 * per_hour < 2 * hours * per_hour
    assert sorted(r[1] for r in found) == sorted({r[1] for r in obs})
    assert [r[2:] for r in found if r[1] == 0] == [("success", "success", T0, 0)]


def test_runs_that_end_again_after_silence_are_reported_anew(spark, tmp_path):
    at = lambda h: T0 + timedelta(hours=h)
    obs = [(1, 1, at(0), "dead"), (2, 9, at(30), "success"), (3, 1, at(60), "success")]
    result = first_terminal_stream(stream_of(spark, tmp_path / "in", obs, 3), keep_sec=3600)
    with with_rocksdb(spark):
        _, found = state_rows(result, "update", tmp_path / "state")
    assert [r[2] for r in found if r[1] == 1] == ["failed", "success"]


def test_outcome_state_is_empty_in_the_end(spark, tmp_path):
    """Neither rows whose start never comes nor runs that go on after their report stay."""
    obs = [(i, i, T0 + timedelta(seconds=i), "success" if i % 2 else "running") for i in range(40)]  # no start
    # Run 500 has a start, is reported, forgotten, and goes on ending.
    obs += [(1000 + i, 500, T0 + timedelta(seconds=50 * i), "success") for i in range(20)]
    obs.sort(key=lambda r: r[2])
    obs.append((9999, 501, T0 + timedelta(days=1), "running"))
    runs = spark.createDataFrame([(500, T0), (600, T0)], "run_id BIGINT, start_ts TIMESTAMP")
    _, started = starts_of(spark, runs, tmp_path / "runs")
    result = run_outcome_stream(stream_of(spark, tmp_path / "in", obs, 5), started, 60, wait_sec=120)
    with with_rocksdb(spark):
        sizes, found = state_rows(result, "append", tmp_path / "state")
    assert sizes[-1] == 0 < max(sizes)
    assert sorted(r[1:3] for r in found) == [(500, "success"), (600, "timeout")]


def test_rows_wait_for_their_start_only_so_long(spark, tmp_path):
    at = lambda s: T0 + timedelta(seconds=s)
    obs = [(1, 1, at(0), "success"), (2, 2, at(5), "success")]
    obs += [(i, 9, at(s), "running") for i, s in ((3, 50), (4, 300), (5, 900), (6, 950))]
    # The start of run 2 comes in time, that of run 1 long after its row was forgotten.
    for part in [(71, at(5000))], [(2, at(0))], [(72, at(5000))], [(73, at(5000))], [(74, at(5000))], [(1, at(0))]:
        made = spark.createDataFrame(part, "run_id BIGINT, start_ts TIMESTAMP")
        made.coalesce(1).write.mode("append").parquet(str(tmp_path / "starts"))
    started = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "starts"))
    observed = stream_of(spark, tmp_path / "in", obs, 6)
    with with_rocksdb(spark):
        _, found = state_rows(run_outcome_stream(observed, started, 30, wait_sec=100), "append", tmp_path / "state")
    assert sorted(r[1:4] for r in found) == [(1, "timeout", at(30)), (2, "success", at(5))]


def test_runs_share_rows_of_state(spark, tmp_path, monkeypatch):
    """A few buckets of runs have a row and a timer each, however many runs there are."""
    monkeypatch.setattr(streaming_outcome, "BUCKETS", 4)
    at = lambda s: T0 + timedelta(seconds=s)
    obs = [(i, i, at(i % 3), "success" if i % 2 else "running") for i in range(100)] + [(999, 999, at(900), "running")]
    runs = spark.createDataFrame([(i, T0) for i in range(100)], "run_id BIGINT, start_ts TIMESTAMP")
    _, started = starts_of(spark, runs, tmp_path / "runs")
    result = run_outcome_stream(stream_of(spark, tmp_path / "in", obs, 2), started, 60)
    with with_rocksdb(spark):
        sizes, found = state_rows(result, "append", tmp_path / "state")
    # A bucket has its row and a timer in two tables.
    assert 0 < max(sizes) <= 4 * 3
    assert sorted(r[1:3] for r in found) == [(i, "success" if i % 2 else "timeout") for i in range(100)]


def test_provider_setting_is_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with with_rocksdb(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key) == before
