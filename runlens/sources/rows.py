"""Literal rows and integer ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runlens.functions.text import quote_name


def id_range(spark: SparkSession, start: int, end: int | None = None) -> DataFrame:
    """`id BIGINT` from `start` up to but without `end` (or 0 up to `start`)."""
    return spark.range(start) if end is None else spark.range(start, end)


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str], types: list[str]) -> DataFrame:
    """A small hand-written table whose column names are run parameters."""
    ddl = ", ".join(f"{quote_name(name)} {kind}" for name, kind in zip(names, types, strict=True))
    return spark.createDataFrame(rows, ddl)


def literal_column(spark: SparkSession, values: list[str], name: str) -> DataFrame:
    """A list of strings as a one-column table."""
    return literal_rows(spark, [(value,) for value in values], [name], ["STRING"])
