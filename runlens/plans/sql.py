"""SQL text with typed parameters, and ordered scripts that stop at a failure."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

Statement = str | Callable[[SparkSession], DataFrame | None]


def run_sql(
    spark: SparkSession,
    text: str,
    args: dict | None = None,
    defaults: dict | None = None,
    optional: tuple[str, ...] = (),
) -> DataFrame:
    """Run SQL with named parameters (`:name`, or `IDENTIFIER(:name)` for names).

    Values are bound, never spliced into the text. An empty value falls back to its
    default, and a name listed in `optional` that has no value becomes empty text.
    """
    bound = {name: "" for name in optional}
    bound.update(defaults or {})
    bound.update({name: value for name, value in (args or {}).items() if value or name not in bound})
    return spark.sql(text, args=bound)


@dataclass(frozen=True)
class ScriptRun:
    """Results of the statements that ran, and a status row for every statement."""

    results: list[DataFrame | None]
    status: DataFrame

    @property
    def last(self) -> DataFrame | None:
        """Result of the last statement that ran; None if the first one failed."""
        return self.results[-1] if self.results else None


def run_script(
    spark: SparkSession,
    statements: list[Statement],
    args: dict | None = None,
    execute: bool = True,
) -> ScriptRun:
    """Run statements in order in one session; after a failure none of the rest runs.

    A statement is SQL text, or a function of the session such as `JoinJob.run`. What
    one registers is there for the next. With `execute` each result is computed in
    full on the executors (into Spark's no-op sink), so that a failure at run time
    stops the script too; without it only analysis errors do. `status` holds
    (pos, status, error) with status ok / failed / not_run.
    """
    results: list[DataFrame | None] = []
    rows: list[tuple] = []
    for pos, statement in enumerate(statements):
        if rows and rows[-1][1] != "ok":
            rows.append((pos, "not_run", None))
            continue
        try:
            is_text = isinstance(statement, str)
            result = spark.sql(statement, args=args or {}) if is_text else statement(spark)
            if execute and result is not None and result.columns:
                result.write.format("noop").mode("overwrite").save()
            results.append(result)
            rows.append((pos, "ok", None))
        except Exception as error:  # whatever a statement fails with stops the script
            condition = error.getCondition() if isinstance(error, PySparkException) else None
            rows.append((pos, "failed", condition or type(error).__name__))
    status = spark.createDataFrame(rows, "pos INT, status STRING, error STRING")
    return ScriptRun(results, status)
