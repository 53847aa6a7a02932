"""Ordered statements of a session: the first failure stops the rest.

Statements are rows (session_id, pos, state, status, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.functions.states import classify_statement
from runlens.operators.skew import HOT_PART, MIN_HOT_ROWS, split_join


def fail_fast(
    statements: DataFrame, hot_part: float = HOT_PART, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """Add `run_class`: that of the statement, or `not_run` after a failure.

    Statements that were malformed stop the session as well. The first failure per
    session is a small aggregate, so no session has to fit one task.
    """
    classed = statements.withColumn("run_class", classify_statement("state", "status"))
    first_failure = (
        classed.filter(F.col("run_class").isin("failed", "malformed"))
        .groupBy("session_id")
        .agg(F.min("pos").alias("first_failed_pos"))
    )
    joined = split_join(classed, first_failure, "session_id", "left", hot_part, min_hot_rows)
    return joined.withColumn(
        "run_class",
        F.when(F.col("pos") > F.col("first_failed_pos"), "not_run").otherwise(F.col("run_class")),
    )


def script_summary(
    statements: DataFrame, hot_part: float = HOT_PART, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """Per session: statements submitted, whether all succeeded, first failure."""
    return (
        fail_fast(statements, hot_part, min_hot_rows)
        .groupBy("session_id")
        .agg(
            F.count(F.lit(1)).alias("n_statements"),
            F.count_if(F.col("run_class") != "not_run").alias("n_submitted"),
            F.bool_and(F.col("run_class") == "success").alias("all_succeeded"),
            F.min("first_failed_pos").alias("first_failed_pos"),
        )
    )
