"""Classes of observed states: still pending, succeeded, or failed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from runlens.functions.text import as_column

# States a batch run passes through before it ends.
PENDING_BATCH_STATES = (
    "not_started",
    "starting",
    "recovering",
    "idle",
    "running",
    "busy",
    "shutting_down",
)
# States of a statement that has not finished.
PENDING_STATEMENT_STATES = ("waiting", "running")


def classify_batch(state: Column | str) -> Column:
    """pending / success / failed; unknown and NULL states count as failed."""
    state = as_column(state)
    return (
        F.when(state.isin(*PENDING_BATCH_STATES), "pending")
        .when(state == "success", "success")
        .otherwise("failed")
    )


def classify_session(state: Column | str) -> Column:
    """pending / ready / failed for a session that is being started."""
    state = as_column(state)
    return F.when(state == "starting", "pending").when(state == "idle", "ready").otherwise("failed")


def classify_statement(
    state: Column | str, status: Column | str, has_status: Column | str | None = None
) -> Column:
    """pending / success / failed / malformed from a statement's state and status.

    The status counts only once the state is `available`; a reply without one is then
    malformed. `has_status` tells a missing status from one that is present but null,
    which is a failure; without it a NULL status counts as missing.
    """
    state, status = as_column(state), as_column(status)
    present = status.isNotNull() if has_status is None else as_column(has_status)
    return (
        F.when(state.isin(*PENDING_STATEMENT_STATES), "pending")
        .when((state == "available") & ~present, "malformed")
        .when((state == "available") & (status == "ok"), "success")
        .otherwise("failed")
    )


@dataclass(frozen=True)
class Rule:
    """How rows of one kind are classed: the columns it looks at, and the class of their values.

    Every class but `pending` ends a run.
    """

    columns: tuple[str, ...]
    classify: Callable[..., Column]

    def __call__(self, of: str = "") -> Column:
        """Class of a row, or of the columns of the struct `of`."""
        return self.classify(*(F.col(f"{of}.{c}" if of else c) for c in self.columns))

    def ends(self, of: str = "") -> Column:
        return self(of) != "pending"


BATCH = Rule(("state",), classify_batch)
SESSION = Rule(("state",), classify_session)
STATEMENT = Rule(("state", "status"), classify_statement)
# With a column that tells a missing status from one that is null.
STATEMENT_REPLY = Rule(("state", "status", "has_status"), classify_statement)
