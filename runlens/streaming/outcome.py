"""Run outcomes over a stream of observations.

The stream has rows (run_id, event_id, ts TIMESTAMP, state); the starts, a stream as well,
(run_id, start_ts TIMESTAMP), where start_ts is the time the run was submitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from runlens.functions.states import BATCH, Rule
from runlens.operators.outcome import MICROS
from runlens.operators.validate import DEFAULT_TIMEOUT_SEC
from runlens.session import remove_at_end, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"

# Seconds that a decided run is remembered after its last terminal observation.
KEEP_SEC = 24 * 3600

# Runs share rows of state in so many buckets, of which a task holds one at a time. A
# stream that was begun with one number can't go on with another.
BUCKETS = 2048


def _thin_out(latest_per_run: bool):
    """Keep, per run and Arrow batch, the start and the first terminal row, and one latest row.

    The start sets the deadline, the first terminal row is the only one that can decide
    the run, and the latest row of the batch moves the watermark on; so a run with very
    many rows sends a few of them to the task that keeps its state. `latest_per_run` keeps
    the last terminal row of each run as well, which tells how long it is remembered.
    Defined inside a function so that executors need no copy of this package.
    """

    def thin_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("event_id").fill_null(-(1 << 63)).to_numpy()
            order = np.lexsort((ids, batch.column("ts_us").to_numpy()))
            run = batch.column("run_id").dictionary_encode().indices.to_numpy()
            starts, ends = (
                batch.column(x).fill_null(False).to_numpy(zero_copy_only=False) for x in ("starts", "terminal")
            )

            def one_per_run(places):
                return places[np.unique(run[places], return_index=True)[1]]

            kept = [one_per_run(order[starts[order]]), one_per_run(order[ends[order]]), order[~starts[order]][-1:]]
            if latest_per_run:
                kept.append(one_per_run(order[ends[order]][::-1]))
            yield batch.take(pa.array(np.unique(np.concatenate(kept))))

    return thin_out


def _observed(stream: DataFrame, rule: Rule) -> DataFrame:
    """Observations with their class, whether they end a run, and their time in microseconds."""
    return stream.select(
        "run_id", "event_id", "ts", "state",
        F.unix_micros("ts").alias("ts_us"),
        rule().alias("outcome"),
        rule.ends().alias("terminal"),
        F.lit(False).alias("starts"),
    ).filter(F.col("run_id").isNotNull() & F.col("ts_us").isNotNull())


def _bucket() -> Column:
    return F.pmod(F.xxhash64("run_id"), F.lit(BUCKETS))


def _bucket_processor(columns: str) -> type[StatefulProcessor]:
    """A processor whose keys are buckets of runs, with a row of state and a timer for each.

    A call to the state store or for a timer costs about as much as the work on many rows,
    so runs share them. A bucket's state has an array of each of `columns`, of which the
    first is the run and the last, `due_ms`, the time when something is to be done for it;
    the timer is that of the run that is due first. Defined inside a function as above.
    """

    class BucketProcessor(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            arrays = (x.split() for x in columns.split(", "))
            schema = ", ".join(f"{name} ARRAY<{kind}>" for name, kind in arrays)
            self.bucket = handle.getValueState("runs", f"{schema}, timer_ms BIGINT")

        def load(self):
            """The runs of the bucket, by run_id, and when its timer is due."""
            known = self.bucket.get()
            if known is None:
                return {}, None
            run_ids, *values, timer_ms = known
            return dict(zip(run_ids, zip(*values))), timer_ms

        def save(self, runs, timer_ms):
            """`timer_ms`: that of the timer that is set, None if it is none or has just expired."""
            next_ms = min((run[-1] for run in runs.values()), default=None)
            if timer_ms != next_ms:
                if timer_ms is not None:
                    self.handle.deleteTimer(timer_ms)
                if next_ms is not None:
                    self.handle.registerTimer(next_ms)
            if runs:
                self.bucket.update((list(runs), *map(list, zip(*runs.values())), next_ms))
            else:
                self.bucket.clear()

        def close(self) -> None:
            pass

    return BucketProcessor


def _first_terminal_processor(keep_us: int) -> StatefulProcessor:
    """Per run: its first terminal row so far, reported when it changes, until it has been silent."""

    class FirstTerminalProcessor(_bucket_processor("run_id BIGINT, first_us BIGINT, first_id BIGINT, last_us BIGINT, due_ms BIGINT")):
        def handleInputRows(self, key, rows, timerValues):
            order = lambda row: (row.ts_us, row.event_id is not None, row.event_id or 0)
            ends = {}
            for row in rows:
                if row.terminal:
                    best, last_us = ends.get(row.run_id, (row, row.ts_us))
                    ends[row.run_id] = (min(best, row, key=order), max(last_us, row.ts_us))
            if not ends:
                return
            runs, timer_ms = self.load()
            watermark_ms = timerValues.getCurrentWatermarkInMs()
            for run_id, (best, last_us) in ends.items():
                known = runs.get(run_id)
                # Timers are due after the rows of a batch; what should be gone by now is gone.
                if known is None or self.silent_ms(known[2]) <= watermark_ms:
                    runs[run_id] = (best.ts_us, best.event_id, last_us, max(self.silent_ms(last_us), watermark_ms + 1))
                    yield self.report(best)
                    continue
                first_us, first_id, known_us, due_ms = known
                if order(best) < (first_us, first_id is not None, first_id or 0):
                    first_us, first_id = best.ts_us, best.event_id
                    yield self.report(best)
                last_us = max(last_us, known_us)
                runs[run_id] = (first_us, first_id, last_us, max(due_ms, self.silent_ms(last_us)))
            self.save(runs, timer_ms)

        def silent_ms(self, last_us):
            return -(-(last_us + keep_us) // 1000)

        def report(self, row):
            return Row(run_id=row.run_id, outcome=row.outcome, state=row.state, decided_us=row.ts_us, event_id=row.event_id)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            runs, timer_ms = self.load()
            if expiredTimerInfo.getExpiryTimeInMs() == timer_ms:
                watermark_ms = timerValues.getCurrentWatermarkInMs()
                self.save({run_id: run for run_id, run in runs.items() if run[-1] > watermark_ms}, None)
            yield from ()

    return FirstTerminalProcessor()


def first_terminal_stream(
    stream: DataFrame, rule: Rule = BATCH, keep_sec: int = KEEP_SEC, delay: str = "0 seconds"
) -> DataFrame:
    """First terminal observation per run, updated as observations arrive.

    Use output mode update, where the latest row of a run replaces earlier ones, and
    `with_rocksdb`. Only observations that can decide a run are kept: a run has its place in
    the state from its first one on, until `keep_sec` after its last one by the watermark, which
    follows the latest observation of any run by `delay`. A run that ends again after such
    a silence is reported anew; rows later than the watermark are dropped. So state grows
    with the runs that ended within `keep_sec`, not with all that ever did.
    """
    timed = _observed(stream, rule)
    timed = timed.mapInArrow(_thin_out(True), timed.schema).withWatermark("ts", delay)
    return (
        timed.withColumn("bucket", _bucket())
        .groupBy("bucket")
        .transformWithState(
            statefulProcessor=_first_terminal_processor(keep_sec * MICROS),
            outputStructType="run_id BIGINT, outcome STRING, state STRING, decided_us BIGINT, event_id BIGINT",
            outputMode="Update",
            timeMode="eventTime",
        )
        .select("run_id", "outcome", "state", F.timestamp_micros("decided_us").alias("decided_ts"), "event_id")
    )


def _outcome_processor(timeout_us: int, wait_us: int) -> StatefulProcessor:
    """Per run: learn its start, wait for a terminal row or the deadline, report once, forget.

    Whatever is kept of a run has one time when it is due to be reported or forgotten.
    """

    columns = (
        "run_id BIGINT, deadline_us BIGINT, first_us BIGINT, first_id BIGINT, "
        "state STRING, outcome STRING, reported BOOLEAN, due_ms BIGINT"
    )

    class OutcomeProcessor(_bucket_processor(columns)):
        def handleInputRows(self, key, rows, timerValues):
            runs, timer_ms = self.load()
            unknown, changed = (None,) * 5 + (False, None), {}
            for row in rows:
                run_id = row.run_id
                deadline_us, first_us, first_id, state, outcome, reported, due_ms = runs.get(run_id, unknown)
                if reported:
                    continue  # nothing changes a run that was reported
                if row.starts:
                    if deadline_us is not None and row.ts_us + timeout_us >= deadline_us:
                        continue
                    deadline_us = row.ts_us + timeout_us
                elif row.terminal:
                    found = (row.ts_us, row.event_id is not None, row.event_id or 0)
                    if first_us is not None and found >= (first_us, first_id is not None, first_id or 0):
                        continue
                    first_us, first_id, state, outcome = row.ts_us, row.event_id, row.state, row.outcome
                else:
                    continue
                runs[run_id] = (deadline_us, first_us, first_id, state, outcome, False, due_ms)
                changed[run_id] = True
            if not changed:
                return
            # The watermark has whole milliseconds; timers round up to the next one.
            watermark_ms = timerValues.getCurrentWatermarkInMs()
            for run_id in changed:
                deadline_us, first_us, first_id, state, outcome, _, due_ms = runs[run_id]
                if deadline_us is None:
                    # No start yet: the row waits for it, but not for good.
                    if due_ms is None:
                        due_ms = -(-(first_us + wait_us) // 1000)
                        if due_ms <= watermark_ms:
                            del runs[run_id]
                            continue
                else:
                    due_us = deadline_us if first_us is None else min(first_us, deadline_us)
                    due_ms = -(-due_us // 1000)
                    if due_ms <= watermark_ms:  # a start or row that comes after its time
                        yield self.report(run_id, deadline_us, first_us, outcome, state)
                        runs[run_id] = self.until_deadline(deadline_us, watermark_ms)
                        continue
                runs[run_id] = (deadline_us, first_us, first_id, state, outcome, False, due_ms)
            self.save(runs, timer_ms)

        def report(self, run_id, deadline_us, first_us, outcome, state):
            if first_us is not None and first_us <= deadline_us:
                return Row(run_id=run_id, outcome=outcome, decided_us=first_us, state=state)
            return Row(run_id=run_id, outcome="timeout", decided_us=deadline_us, state=None)

        def until_deadline(self, deadline_us, now_ms):
            """A reported run is remembered for as long as its rows may still come."""
            forget_ms = max(-(-deadline_us // 1000), now_ms) + timeout_us // 1000 + 1
            return (deadline_us, None, None, None, None, True, forget_ms)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            runs, timer_ms = self.load()
            if expiredTimerInfo.getExpiryTimeInMs() != timer_ms:
                return  # an earlier timer, due in the same batch as rows that changed it
            watermark_ms = timerValues.getCurrentWatermarkInMs()
            for run_id in [run_id for run_id, run in runs.items() if run[-1] <= watermark_ms]:
                deadline_us, first_us, first_id, state, outcome, reported, due_ms = runs[run_id]
                if reported or deadline_us is None:
                    del runs[run_id]
                    continue
                yield self.report(run_id, deadline_us, first_us, outcome, state)
                runs[run_id] = self.until_deadline(deadline_us, due_ms)
            self.save(runs, None)

    return OutcomeProcessor()


def run_outcome_stream(
    stream: DataFrame,
    starts: DataFrame,
    timeout_sec: int = DEFAULT_TIMEOUT_SEC,
    delay: str = "0 seconds",
    rule: Rule = BATCH,
    wait_sec: int | None = None,
) -> DataFrame:
    """The deciding class or timeout per run, each run reported once (append mode).

    `starts` is a stream too, of (run_id, start_ts): a start is one more event of its run,
    so runs that are never observed are reported as well, and nothing is joined. A run is
    reported when the watermark passes its first terminal observation, or its deadline
    start_ts + `timeout_sec` if none came by then; at once if its start arrives after
    that. Observations of a reported run are ignored, and the run is forgotten one
    timeout after its deadline. Agrees with `run_outcome_at_deadline`. Start the query with
    `with_rocksdb`.

    Rows that do not end a run leave no state. Terminal rows that come before their run's
    start wait for it for `wait_sec` (the timeout, unless said otherwise) after their time,
    and are then forgotten, as are those of a run that goes on after it was forgotten; a
    start that comes still later finds none of them. So all state is gone once the watermark
    has passed it, whatever comes of a run.

    The rows of a run are thinned out before they are shuffled.
    """
    observed = _observed(stream, rule)
    started = starts.select(
        "run_id",
        F.lit(None).cast("long").alias("event_id"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.lit(None).cast("string").alias("state"),
        F.unix_micros("start_ts").alias("ts_us"),
        F.lit(None).cast("string").alias("outcome"),
        F.lit(False).alias("terminal"),
        F.lit(True).alias("starts"),
    ).filter(F.col("run_id").isNotNull() & F.col("ts_us").isNotNull())
    events = observed.unionByName(started)
    # Starts have no time of their own in `ts`: they don't move the watermark, and are
    # not dropped as late, since a late start still wants its report.
    timed = events.mapInArrow(_thin_out(False), events.schema).withWatermark("ts", delay)
    wait_us = (timeout_sec if wait_sec is None else wait_sec) * MICROS
    return (
        timed.withColumn("bucket", _bucket())
        .groupBy("bucket")
        .transformWithState(
            statefulProcessor=_outcome_processor(timeout_sec * MICROS, wait_us),
            outputStructType="run_id BIGINT, outcome STRING, decided_us BIGINT, state STRING",
            outputMode="Append",
            timeMode="eventTime",
        )
        .select(
            "run_id", "outcome", F.timestamp_micros("decided_us").alias("decided_ts"), "state"
        )
    )


class with_rocksdb:
    """Start queries in this block with RocksDB state, which timers need."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(PROVIDER_KEY, None)
        self.spark.conf.set(PROVIDER_KEY, ROCKSDB)

    def __exit__(self, *_):
        if self.before is None:
            self.spark.conf.unset(PROVIDER_KEY)
        else:
            self.spark.conf.set(PROVIDER_KEY, self.before)


def drain(result: DataFrame, mode: str, name: str) -> DataFrame:
    """Process everything there is now into a table, and return it.

    Each micro-batch overwrites its own folder, so one that is repeated after a
    failure does not double its rows. Adds `batch_id`. The table stays until the
    application ends.
    """
    spark = result.sparkSession
    table, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    remove_at_end(spark, table)
    remove_at_end(spark, state)
    spark.createDataFrame([], result.schema).write.parquet(f"{table}/batch_id=-1")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    writer = result.writeStream.foreachBatch(save).outputMode(mode).option("checkpointLocation", state)
    with with_rocksdb(spark):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(table)
