"""Validation of submitted run settings, with the reason for each rejection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of code a session accepts, and systems a result can be
# checked in.
ALLOWED_KINDS = ("spark", "pyspark", "sparkr", "sql")
ALLOWED_VERIFIERS = ("spark", "yarn")
# Poll period and timeout, in seconds, of a batch run.
DEFAULT_POLL_PERIOD_SEC = 20
DEFAULT_TIMEOUT_SEC = 600


@dataclass(frozen=True)
class SettingRules:
    """Columns that hold the settings; a column set to None is not checked."""

    kind: str | None = "kind"
    verify_in: str | None = "verify_in"
    poll_period: str | None = "poke_interval"
    timeout: str | None = "timeout"
    poll_period_default: int = DEFAULT_POLL_PERIOD_SEC
    timeout_default: int = DEFAULT_TIMEOUT_SEC


def _not_in(column: str, allowed: tuple[str, ...]) -> Column:
    # NULL means the setting was left out, which is allowed.
    return F.col(column).isNotNull() & ~F.col(column).isin(*allowed)


def validate(df: DataFrame, rules: SettingRules = SettingRules()) -> DataFrame:
    """Add `reason`: the first broken rule, NULL for valid settings.

    Checked in order: kind, verifier, poll period of at least a second, poll
    period not above the timeout (equal is fine).
    """
    checks = []
    if rules.kind:
        checks.append(F.when(_not_in(rules.kind, ALLOWED_KINDS), "unknown_kind"))
    if rules.verify_in:
        checks.append(F.when(_not_in(rules.verify_in, ALLOWED_VERIFIERS), "unknown_verifier"))
    if rules.poll_period:
        period = F.coalesce(F.col(rules.poll_period), F.lit(rules.poll_period_default))
        checks.append(F.when(period < 1, "poll_period_too_small"))
        if rules.timeout:
            timeout = F.coalesce(F.col(rules.timeout), F.lit(rules.timeout_default))
            checks.append(F.when(period > timeout, "poll_period_above_timeout"))
    return df.withColumn("reason", F.coalesce(*checks, F.lit(None).cast("string")))


def split_valid(df: DataFrame, rules: SettingRules = SettingRules()) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    checked = validate(df, rules)
    return checked.filter("reason IS NULL").drop("reason"), checked.filter("reason IS NOT NULL")
