"""Checking a run's own result against a second system.

Runs are rows (run_id, app_id, state, verify_in, spill_logs); job lists are rows
(app_id, ord, job_id, status) and final results rows (app_id, final_status).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.states import classify_batch
from runlens.operators.skew import HOT_PART, MIN_HOT_ROWS, HotKeys, split_join
from runlens.operators.validate import ALLOWED_VERIFIERS

# Fixed value: the status a job and an application must end with.
SUCCEEDED = "SUCCEEDED"


def _bad_jobs(app_jobs: DataFrame) -> DataFrame:
    """Jobs that did not succeed: all that matters of a job list, and usually little of it.

    What could not be read comes first: such a list is malformed as a whole.
    """
    unread = _unread(app_jobs)
    bad = unread | ~F.col("status").eqNullSafe(F.lit(SUCCEEDED))
    readable = (~unread).alias("readable")
    return app_jobs.filter(F.col("app_id").isNotNull() & bad).select(
        "app_id", F.struct(readable, "ord", "job_id", "status", unread.alias("unread")).alias("bad_job")
    )


def _final_verdicts(app_final: DataFrame) -> DataFrame:
    return app_final.filter(F.col("app_id").isNotNull()).select(
        "app_id", "final_status", F.lit(True).alias("has_final")
    )


def _final_aggregates() -> list[Column]:
    """One final result per application, should there be several rows for one.

    Any status but SUCCEEDED wins over it, and of several such the first in the alphabet;
    a row without a status counts as one that did not succeed.
    """
    succeeded = F.col("final_status").eqNullSafe(F.lit(SUCCEEDED))
    worst = F.min(F.when(F.col("has_final"), F.struct(succeeded, "final_status")))
    return [worst["final_status"].alias("final_status"), F.bool_or("has_final").alias("has_final")]


def _jobs_result() -> Column:
    # An application without jobs passes.
    return (
        F.when(F.col("bad_job").isNull(), "passed")
        .when(F.col("bad_job.unread"), "malformed")
        .otherwise("failed")
    )


def _unread(app_jobs: DataFrame) -> Column:
    """Whether a row stands for a job list, or an entry of one, that could not be read."""
    return F.col("error").isNotNull() if "error" in app_jobs.columns else F.lit(False)


def _final_result() -> Column:
    return (
        F.when(F.col("has_final").isNull(), "malformed")
        .when(F.col("final_status") == SUCCEEDED, "passed")
        .otherwise("failed")
    )


def verify_jobs(
    runs: DataFrame,
    app_jobs: DataFrame,
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the job-list verdict: passed / failed / malformed / no_app_id, and the first bad job.

    `app_jobs` may have an `error`, as `explode_jobs` gives it: a list that could not be
    read, or an entry without its fields, is malformed.
    """
    first_bad = _bad_jobs(app_jobs).groupBy("app_id").agg(F.min("bad_job").alias("bad_job"))
    joined = split_join(runs, first_bad, "app_id", "left", hot_part, min_hot_rows, hot)
    return joined.select(
        *runs.columns,
        F.when(F.col("app_id").isNull(), "no_app_id").otherwise(_jobs_result()).alias("verdict"),
        F.col("bad_job.job_id").alias("bad_job_id"),
        F.col("bad_job.status").alias("bad_status"),
    )


def verify_final(
    runs: DataFrame,
    app_final: DataFrame,
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the final-status verdict: passed / failed / malformed (no row) / no_app_id."""
    verdicts = _final_verdicts(app_final).groupBy("app_id").agg(*_final_aggregates())
    joined = split_join(runs, verdicts, "app_id", "left", hot_part, min_hot_rows, hot)
    return joined.select(
        *runs.columns,
        F.when(F.col("app_id").isNull(), "no_app_id").otherwise(_final_result()).alias("verdict"),
        "final_status",
    )


def _own(runs: DataFrame) -> Column:
    """A run's own result."""
    return F.col("own") if "own" in runs.columns else classify_batch("state")


def reconcile(
    runs: DataFrame,
    app_jobs: DataFrame,
    app_final: DataFrame,
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Overall result: the run must succeed by itself, then its verifier decides.

    A run's own result is its column `own`, such as the outcome of `run_outcome`, or if
    there is none the class of its `state`. Adds `outcome` (success / failed / pending),
    `reason` (NULL unless failed: run_failed, timeout, unknown_verifier, no_app_id,
    bad_jobs_reply, bad_job, no_final_status, bad_final_status) and `bad_status`, the
    status the verifier objected to. A run that has timed out has failed, whatever its
    verifier would say.

    Bad jobs and final results are gathered per application in one aggregate, so they
    and the runs are each shuffled for one join; runs that no verifier has to look at
    carry no key into it.
    """
    per_app = (
        _bad_jobs(app_jobs)
        .unionByName(_final_verdicts(app_final), allowMissingColumns=True)
        .groupBy(F.col("app_id").alias("_app"))
        .agg(F.min("bad_job").alias("bad_job"), *_final_aggregates())
    )
    primary = _own(runs)
    verifier = F.col("verify_in")
    looked_up = (primary == "success") & verifier.isin(*ALLOWED_VERIFIERS)
    joined = split_join(
        runs.withColumn("_app", F.when(looked_up, F.col("app_id"))),
        per_app,
        "_app",
        "left",
        hot_part,
        min_hot_rows,
        hot,
    )
    final_result = _final_result()
    reason = (
        F.when(primary == "pending", F.lit(None))
        .when(primary == "timeout", "timeout")
        .when(primary != "success", "run_failed")
        .when(verifier.isNull(), F.lit(None))
        .when(~verifier.isin(*ALLOWED_VERIFIERS), "unknown_verifier")
        .when(F.col("app_id").isNull(), "no_app_id")
        .when((verifier == "spark") & F.col("bad_job.unread"), "bad_jobs_reply")
        .when((verifier == "spark") & F.col("bad_job").isNotNull(), "bad_job")
        .when((verifier == "yarn") & (final_result == "malformed"), "no_final_status")
        .when((verifier == "yarn") & (final_result == "failed"), "bad_final_status")
    )
    return joined.withColumn("reason", reason).select(
        *runs.columns,
        F.when(primary == "pending", "pending")
        .when(F.col("reason").isNull(), "success")
        .otherwise("failed")
        .alias("outcome"),
        "reason",
        F.when(F.col("reason") == "bad_job", F.col("bad_job.status"))
        .when(F.col("reason") == "bad_final_status", F.col("final_status"))
        .alias("bad_status"),
    )


def disagreements(reconciled: DataFrame) -> DataFrame:
    """Runs that reported success while their verifier disagrees, counted.

    Takes the output of `reconcile`; one row per verifier, reason and status.
    """
    return (
        reconciled.filter((_own(reconciled) == "success") & (F.col("outcome") == "failed"))
        .groupBy("verify_in", "reason", "bad_status")
        .agg(F.count(F.lit(1)).alias("n_runs"))
    )


def wants_logs(spill_by_default: bool = True) -> Column:
    """Whether the logs of a run (run_id, outcome, spill_logs) are to be kept.

    They are if the run was created, so that it has a run_id, and either failed
    (outcome failed or timeout) or asks for them. `spill_by_default` stands in for a
    missing `spill_logs`: batch runs keep logs by default, sessions do not.
    """
    failed = F.col("outcome").isin("failed", "timeout")
    asked = F.coalesce(F.col("spill_logs"), F.lit(spill_by_default))
    return F.col("run_id").isNotNull() & (failed | asked)


def select_logs(
    runs: DataFrame,
    logs: DataFrame,
    spill_by_default: bool = True,
    kept: bool = True,
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Log rows of the runs that want their logs; with `kept=False`, all the others."""
    chosen = runs.filter(wants_logs(spill_by_default)).select("run_id").distinct()
    how = "left_semi" if kept else "left_anti"
    return split_join(logs, chosen, "run_id", how, hot_part, min_hot_rows, hot)
