"""Join two delimited files on any column of each, project, preview, save."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.text import quote_name
from runlens.sources.delimited import read_delimited, register, write_delimited

# The names both inputs go by in a select list, and the preview size.
LEFT, RIGHT = "file1", "file2"
PREVIEW_ROWS = 50


def join_two_files(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    columns: list[str] | str,
    key_type: str | None = None,
) -> DataFrame:
    """Inner equi-join; `columns` is a select list over `file1` and `file2`.

    Equal keys multiply and NULL keys never match. With `key_type` both keys are
    cast first, and a value that does not fit matches nothing (without it, Spark's
    ANSI mode fails on text compared with numbers).

    The join carries no hint. Spark broadcasts a side whose size is below its
    broadcast threshold and sort-merges otherwise. Both sides then come straight
    from a shuffle with only a projection after, which is where adaptive execution
    splits skewed partitions by itself, without the extra pass over the text files
    that finding the hot keys beforehand would cost.
    """

    def key(side: str, name: str) -> Column:
        column = F.col(f"{side}.{quote_name(name)}")
        return column.try_cast(key_type) if key_type else column

    if isinstance(columns, str):
        return _join_by_sql(left, right, left_key, right_key, columns, key_type)
    joined = left.alias(LEFT).join(right.alias(RIGHT), key(LEFT, left_key) == key(RIGHT, right_key))
    return joined.selectExpr(*columns)


def _join_by_sql(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns: str, key_type: str | None
) -> DataFrame:
    """The same join for a select list given as one text, which only SQL can split."""

    def key(side: str, name: str) -> str:
        column = f"{side}.{quote_name(name)}"
        return f"try_cast({column} AS {key_type})" if key_type else column

    def plain(text: str) -> str:
        return text.replace("{", "{{").replace("}", "}}")

    text = (
        f"SELECT {plain(columns)} FROM {{left}} AS {LEFT} JOIN {{right}} AS {RIGHT} "
        f"ON {plain(key(LEFT, left_key))} = {plain(key(RIGHT, right_key))}"
    )
    return left.sparkSession.sql(text, left=left, right=right)


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by: list[Column | str] | None = None) -> DataFrame:
    """The first `n` rows; with `order_by` a top-k that never sorts the whole input."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


@dataclass(frozen=True)
class FileInput:
    """One side of a join job. Without a schema the reader may infer one."""

    path: str
    join_column: str
    schema: str | None = None
    header: bool | str | None = None
    sep: str | None = None
    quote: str | None = None
    escape: str | None = None
    infer_schema: bool | str | None = None
    options: dict = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return read_delimited(
            spark,
            self.path,
            self.schema,
            self.header,
            self.sep,
            self.quote,
            self.escape,
            self.infer_schema,
            **self.options,
        )


@dataclass(frozen=True)
class JoinJob:
    """A whole join job. Nothing is written unless `output_path` is set."""

    file1: FileInput
    file2: FileInput
    output_columns: list[str] | str
    key_type: str | None = None
    output_path: str | None = None
    output_sep: str | None = None
    output_header: bool | str | None = None
    output_mode: str | None = None

    def result(self, spark: SparkSession) -> DataFrame:
        """The joined rows; both inputs are registered under their names for SQL."""
        left = register(self.file1.read(spark), LEFT)
        right = register(self.file2.read(spark), RIGHT)
        return join_two_files(
            left,
            right,
            self.file1.join_column,
            self.file2.join_column,
            self.output_columns,
            self.key_type,
        )

    def run(self, spark: SparkSession) -> DataFrame:
        """Join, save if asked to, and return the joined rows.

        Call `preview` on the result, or on the saved files, to look at some rows;
        it is a separate step because it runs the join again.
        """
        joined = self.result(spark)
        write_delimited(
            joined, self.output_path, self.output_sep, self.output_header, self.output_mode
        )
        return joined
