"""Per-run outcomes from state observations.

Observations are rows (run_id, event_id, ts, state), of which those without a run or
without a time count for nothing; runs are rows (run_id, start_ts), and of several for
a run the earliest start counts. "First" means smallest (ts, event_id). How states are
classed is a `Rule`: of batch runs unless told otherwise, of sessions, or of statements,
whose rows have a status as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from runlens.functions.states import BATCH, Rule
from runlens.operators.skew import HOT_PART, MIN_HOT_ROWS, HotKeys, split_join
from runlens.operators.validate import DEFAULT_POLL_PERIOD_SEC, DEFAULT_TIMEOUT_SEC

MICROS = 1_000_000


def run_starts(obs: DataFrame) -> DataFrame:
    """Runs whose start is their first observation."""
    return (
        obs.filter(F.col("run_id").isNotNull()).groupBy("run_id").agg(F.min("ts").alias("start_ts"))
    )


def _timed(obs: DataFrame) -> DataFrame:
    return obs.filter(F.col("run_id").isNotNull() & F.col("ts").isNotNull())


def _one_start_per_run(runs: DataFrame) -> DataFrame:
    return run_starts(runs.withColumnRenamed("start_ts", "ts"))


def _first_per_run(obs: DataFrame, wanted: Column, columns: list[Column | str]) -> DataFrame:
    """(run_id, first): the first wanted observation of each run, NULL if there is none.

    One pass over the observations with partial results before the shuffle: however
    many rows a run has, each task sends one on.
    """
    found = F.min(F.when(wanted & F.col("ts").isNotNull(), F.struct("ts", "event_id", *columns)))
    return obs.filter(F.col("run_id").isNotNull()).groupBy("run_id").agg(found.alias("first"))


def elapsed_micros(ts: Column, start: Column) -> Column:
    """Microseconds from `start` to `ts`, for either timestamp type."""
    return F.unix_micros(ts.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))


def after_seconds(start: Column, seconds: Column | int) -> Column:
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    return start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def first_terminal(obs: DataFrame, rule: Rule = BATCH) -> DataFrame:
    """The first terminal observation of each run decides it; without one it is pending."""
    return _first_per_run(obs, rule.ends(), list(rule.columns)).select(
        "run_id",
        F.when(F.col("first").isNull(), "pending")
        .otherwise(rule("first"))
        .alias("outcome"),
        F.col("first.state").alias("state"),
        F.col("first.ts").alias("decided_ts"),
        F.col("first.event_id").alias("event_id"),
    )


def first_nonempty(obs: DataFrame, field: str, name: str = "value") -> DataFrame:
    """The first value of `field` per run that is neither NULL nor empty, if any."""
    value = F.col(field)
    found = _first_per_run(obs, value != "", [value.alias("v")])
    return found.select("run_id", F.col("first.v").alias(name))


def deciding_rows(
    obs: DataFrame,
    runs: DataFrame,
    timeout_sec: int = DEFAULT_TIMEOUT_SEC,
    rule: Rule = BATCH,
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Observations any of which, as the first of its run, decides it by the rule of `run_outcome`."""
    timed = split_join(
        _timed(obs).select("run_id", "event_id", "ts", *rule.columns),
        _one_start_per_run(runs),
        "run_id",
        "inner",
        hot_part,
        min_hot_rows,
        hot,
    )
    late = elapsed_micros(F.col("ts"), F.col("start_ts")) > timeout_sec * MICROS
    return timed.filter(rule.ends() | late)


def run_outcome(
    obs: DataFrame,
    runs: DataFrame,
    timeout_sec: int = DEFAULT_TIMEOUT_SEC,
    rule: Rule = BATCH,
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The class of the deciding observation, or timeout or pending, for each run.

    Decided by the first observation that is terminal, or still pending more than
    `timeout_sec` after the start: a terminal state seen late still counts if no
    pending one was seen past the timeout before it.
    """
    decided = deciding_rows(obs, runs, timeout_sec, rule, hot_part, min_hot_rows, hot)
    first = F.min(F.struct("ts", "event_id", *rule.columns)).alias("first")
    kind = rule("first")
    return (
        _one_start_per_run(runs)
        .select("run_id")
        .join(decided.groupBy("run_id").agg(first), "run_id", "left")
        .select(
            "run_id",
            F.when(F.col("first").isNull(), "pending")
            .when(kind == "pending", "timeout")
            .otherwise(kind)
            .alias("outcome"),
            F.col("first.ts").alias("decided_ts"),
            F.col("first.state").alias("state"),
        )
    )


def run_outcome_at_deadline(
    obs: DataFrame,
    runs: DataFrame,
    timeout_sec: int = DEFAULT_TIMEOUT_SEC,
    as_of: Column | None = None,
    rule: Rule = BATCH,
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Like `run_outcome`, but the deadline itself ends a run.

    Only terminal observations up to start + `timeout_sec` count. A run without one
    is a timeout once its deadline lies before `as_of` (default: the latest
    observation of any run), else pending. This is the rule a stream can apply with
    a timer; `runlens.streaming.outcome` must agree with it.
    """
    if as_of is None:
        as_of = obs.agg(F.max("ts")).scalar()
    starts = _one_start_per_run(runs)
    timed = split_join(
        _timed(obs).filter(rule.ends()).select("run_id", "event_id", "ts", *rule.columns),
        starts,
        "run_id",
        "inner",
        hot_part,
        min_hot_rows,
        hot,
    )
    in_time = elapsed_micros(F.col("ts"), F.col("start_ts")) <= timeout_sec * MICROS
    decided = (
        timed.filter(in_time)
        .groupBy("run_id")
        .agg(F.min(F.struct("ts", "event_id", *rule.columns)).alias("first"))
    )
    deadline = after_seconds(F.col("start_ts"), timeout_sec)
    timed_out = F.col("first").isNull() & (deadline < as_of)
    return (
        starts.join(decided, "run_id", "left")
        .select(
            "run_id",
            F.when(timed_out, "timeout")
            .when(F.col("first").isNull(), "pending")
            .otherwise(rule("first"))
            .alias("outcome"),
            F.when(timed_out, deadline).otherwise(F.col("first.ts")).alias("decided_ts"),
            F.col("first.state").alias("state"),
        )
    )


def polls_until_done(
    obs: DataFrame,
    rule: Rule = BATCH,
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Observations of each run up to and including the one that decided it.

    `n_polls` counts all of them for a run that is not decided yet.
    """
    obs = _timed(obs)
    decisions = (
        obs.filter(rule.ends())
        .groupBy("run_id")
        .agg(F.min(F.struct("ts", "event_id")).alias("decision"))
    )
    made = split_join(
        obs.select("run_id", "event_id", "ts"),
        decisions,
        "run_id",
        "left",
        hot_part,
        min_hot_rows,
        hot,
    )
    counted = F.col("decision").isNull() | (F.struct("ts", "event_id") <= F.col("decision"))
    return (
        made.filter(counted)
        .groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("n_polls"),
            F.bool_or(F.col("decision").isNotNull()).alias("decided"),
        )
    )


def sample_states(
    obs: DataFrame,
    runs: DataFrame,
    period_sec: int = DEFAULT_POLL_PERIOD_SEC,
    timeout_sec: int = DEFAULT_TIMEOUT_SEC,
    stop_when_done: bool = False,
    rule: Rule = BATCH,
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The state each run is in at its start and every `period_sec` up to the timeout.

    (run_id, poll_no, poll_ts, state); the state is NULL before the first
    observation. `stop_when_done` leaves out the polls after the first one that finds
    the run ended.

    No range join: arithmetic assigns each observation to the first poll at or after
    it, and the latest one per poll is kept, before the shuffle too. What is left of a
    run is at most one row per poll; each stands until the next, and the polls in
    between are made last, where nothing shuffles them any more.
    """
    last_poll = timeout_sec // period_sec
    period = period_sec * MICROS
    starts = _one_start_per_run(runs)
    timed = split_join(
        _timed(obs).select("run_id", "event_id", "ts", "state", rule.ends().alias("ends")),
        starts,
        "run_id",
        "inner",
        hot_part,
        min_hot_rows,
        hot,
    )
    waited = elapsed_micros(F.col("ts"), F.col("start_ts")) + F.lit(period - 1)
    poll_no = F.greatest(F.lit(0), F.call_function("div", waited, F.lit(period))).cast("int")
    seen = timed.select(
        "run_id", poll_no.alias("poll_no"), F.struct("ts", "event_id", "state", "ends").alias("seen")
    ).filter(F.col("poll_no") <= last_poll)
    # Every run has a row for its first poll, which also brings the start along.
    first_polls = starts.withColumn("poll_no", F.lit(0))
    latest = (
        first_polls.unionByName(seen, allowMissingColumns=True)
        .groupBy("run_id", "poll_no")
        .agg(F.max("seen").alias("seen"), F.max("start_ts").alias("start_ts"))
    )
    by_poll = Window.partitionBy("run_id").orderBy("poll_no")
    earlier = by_poll.rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.col("seen.ends"), F.lit(False))
    spans = latest.select(
        "run_id",
        "poll_no",
        F.col("seen.state").alias("state"),
        F.first("start_ts").over(by_poll).alias("start_ts"),
        F.coalesce(F.lead("poll_no").over(by_poll) - 1, F.lit(last_poll)).alias("until"),
        ended.alias("ended"),
        F.coalesce(F.max(ended).over(earlier), F.lit(False)).alias("over"),
    )
    if stop_when_done:
        spans = spans.filter(~F.col("over")).withColumn(
            "until", F.when(F.col("ended"), F.col("poll_no")).otherwise(F.col("until"))
        )
    polls = spans.select(
        "run_id", "start_ts", "state", F.explode(F.sequence("poll_no", "until")).alias("poll_no")
    )
    return polls.select(
        "run_id",
        "poll_no",
        after_seconds(F.col("start_ts"), F.col("poll_no") * period_sec).alias("poll_ts"),
        "state",
    )
