"""Verdicts of whole run histories in one pass over each input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.states import BATCH, Rule
from runlens.operators.outcome import deciding_rows
from runlens.operators.skew import HOT_PART, MIN_HOT_ROWS, HotKeys
from runlens.operators.validate import DEFAULT_TIMEOUT_SEC
from runlens.operators.verify import reconcile, wants_logs

_SETTINGS = ("app_id", "verify_in", "spill_logs")


def run_verdicts(
    runs: DataFrame,
    starts: DataFrame,
    obs: DataFrame,
    app_jobs: DataFrame,
    app_final: DataFrame,
    logs: DataFrame,
    timeout_sec: int = DEFAULT_TIMEOUT_SEC,
    rule: Rule = BATCH,
    spill_by_default: bool = True,
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot_runs: HotKeys | None = None,
    hot_apps: HotKeys | None = None,
) -> DataFrame:
    """What became of every run: (run_id, own, outcome, reason, bad_status, n_lines).

    `runs` are rows (run_id, app_id, verify_in, spill_logs), of which each run gives one row
    here; of several for a run the smallest counts, and those without a run_id for nothing.
    `own` is the outcome by its observations, as `run_outcome` gives it; a run without a
    start or an observation that decides it is pending. Then its verifier decides, as in
    `reconcile`. `n_lines` counts the rows of `logs` (run_id) of a run that wants them, and
    is NULL if it does not or has none.

    Each input is read once. What decides a run, its settings and its number of log rows are
    events of that run: they meet in one aggregate, with partial results before the shuffle,
    instead of one join each. What is known of applications is another, and the two meet in
    one join. Observations are joined to the starts before, to know which ones are late; log
    rows are counted before, so that only counts are sorted by run.

    `hot_runs` are hot keys of `obs`, `hot_apps` of `runs`; without them, each of the two
    joins looks for its own and reads its rows again.
    """
    decided = deciding_rows(obs, starts, timeout_sec, rule, hot_part, min_hot_rows, hot_runs)
    settings = F.struct(*_SETTINGS)
    first = F.struct("ts", "event_id", *rule.columns)
    events = (
        runs.select("run_id", settings.alias("settings"))
        .unionByName(decided.select("run_id", first.alias("first")), allowMissingColumns=True)
        .unionByName(logs.groupBy("run_id").agg(F.count(F.lit(1)).alias("lines")), allowMissingColumns=True)
    )
    per_run = (
        events.filter(F.col("run_id").isNotNull())
        .groupBy("run_id")
        .agg(
            F.min("settings").alias("settings"),
            F.min("first").alias("first"),
            F.max("lines").alias("n"),
        )
        .filter(F.col("settings").isNotNull())
    )
    kind = rule("first")
    own: Column = (
        F.when(F.col("first").isNull(), "pending").when(kind == "pending", "timeout").otherwise(kind).alias("own")
    )
    known = per_run.select("run_id", own, *(F.col(f"settings.{x}").alias(x) for x in _SETTINGS), "n")
    if hot_apps is None:
        hot_apps = HotKeys.find(runs, key="app_id", hot_part=hot_part, min_hot_rows=min_hot_rows)
    result = reconcile(known, app_jobs, app_final, hot_part, min_hot_rows, hot_apps)
    kept = F.when(wants_logs(spill_by_default), F.col("n")).alias("n_lines")
    return result.select("run_id", "own", "outcome", "reason", "bad_status", kept)
