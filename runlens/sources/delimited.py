"""Delimited text: scans with a declared or inferred schema, and the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.text import quote_name

# Defaults of the delimited reader and writer.
DEFAULT_SEP = "\t"
DEFAULT_QUOTE = '"'
DEFAULT_ESCAPE = "\\"
DEFAULT_MODE = "overwrite"


def clean_options(options: dict) -> dict:
    """Options that carry a value; the rest are left to Spark's own defaults."""
    return {name: value for name, value in options.items() if value is not None and value != ""}


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    header: bool | str | None = None,
    sep: str | None = None,
    quote: str | None = None,
    escape: str | None = None,
    infer_schema: bool | str | None = None,
    **options,
) -> DataFrame:
    """Scan delimited files at any path Spark can open (`file:`, `hdfs:`, `s3:`, ...).

    `schema` is a DDL string applied by position, and wins over inference.
    Inference reads every byte once more, so declare the schema for big files.
    Malformed rows follow Spark's `mode` option (PERMISSIVE: bad value -> NULL);
    pass `mode="FAILFAST"` to stop instead.
    """
    kept = clean_options(
        {
            "header": header,
            "sep": sep or DEFAULT_SEP,
            "quote": quote or DEFAULT_QUOTE,
            "escape": escape or DEFAULT_ESCAPE,
            "inferSchema": None if schema else infer_schema,
            **options,
        }
    )
    reader = spark.read.options(**kept)
    if schema:
        reader = reader.schema(schema)
    return reader.csv(path)


# Columns that a checked scan adds.
RECORD, REASON, COLUMN = "_record", "_reason", "_column"
# A text that stands for NULL nowhere, so that an empty field and a missing one differ.
_NEVER = "\u0000"


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    header: bool | str | None = None,
    sep: str | None = None,
    quote: str | None = None,
    escape: str | None = None,
    **options,
) -> DataFrame:
    """Scan delimited files and say of each row whether, and why, it is to be rejected.

    Adds `_reason` (NULL for a good row), `_record`, the text of a bad one, and `_column`, the
    first column it is about. `short_row` and `long_row` have fewer or more fields than the
    schema, and `_column` is the first one that is missing; a `bad_value` is not of its
    column's type. Fields of bad rows that could be read are there. An empty field is NULL
    and fine.

    One scan gives both kinds; only the text of bad rows is looked at again. All columns are
    read, whichever are wanted, since a row is bad for any of them.
    """
    fields = T.StructType.fromDDL(schema).fields
    taken = {RECORD, REASON, COLUMN}.intersection(f.name for f in fields)
    if taken:
        raise ValueError(f"columns of these names are added: {sorted(taken)}")
    found = read_delimited(
        spark, path, f"{schema}, `{RECORD}` STRING", header, sep, quote, escape,
        mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD, columnPruning="false", **options,
    )
    raw = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(len(fields) + 1)])
    same = {"sep": sep or DEFAULT_SEP, "quote": quote or DEFAULT_QUOTE, "escape": escape or DEFAULT_ESCAPE}
    texts = F.from_csv(RECORD, raw.simpleString()[7:-1].replace(":", " "), {**same, "nullValue": _NEVER, "emptyValue": ""})
    # Spark looks for bad values in the columns it needs only, so all go in; no hash is below that.
    names = [F.col(quote_name(f.name)) for f in fields]
    is_bad = F.col(RECORD).isNotNull() | (F.hash(*names) < F.lit(-(1 << 31)))
    text = [F.col(f"_texts.f{i}") for i in range(len(fields) + 1)]
    missing = F.coalesce(*(F.when(text[i].isNull(), F.lit(f.name)) for i, f in enumerate(fields)), F.lit(None))
    unread = F.coalesce(
        *(F.when(F.col(quote_name(f.name)).isNull() & (text[i] != ""), F.lit(f.name)) for i, f in enumerate(fields)),
        F.lit(None),
    )
    reason = F.when(text[-1].isNotNull(), "long_row").when(missing.isNotNull(), "short_row").otherwise("bad_value")
    column = F.when(text[-1].isNotNull(), F.lit(None)).otherwise(F.coalesce(missing, unread))
    return found.withColumn("_texts", F.when(is_bad, texts)).select(
        *names, F.when(is_bad, reason).alias(REASON), F.when(is_bad, column).alias(COLUMN), RECORD
    )


def good_rows(checked: DataFrame) -> DataFrame:
    """The rows of a checked scan that are as the schema says."""
    return checked.filter(F.col(REASON).isNull()).drop(RECORD, REASON, COLUMN)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """The text of all others, and what is wrong: (_reason, _column, _record)."""
    return checked.filter(F.col(REASON).isNotNull()).select(REASON, COLUMN, RECORD)


def write_delimited(
    df: DataFrame,
    path: str | None,
    sep: str | None = None,
    header: bool | str | None = None,
    mode: str | None = None,
    **options,
) -> bool:
    """Save `df` as a folder of delimited files; no path means no write.

    Returns whether a write was asked for. Quote and escape keep Spark's
    defaults on the way out.
    """
    if not path:
        return False
    kept = clean_options({"sep": sep or DEFAULT_SEP, "header": header, **options})
    df.write.options(**kept).mode(mode or DEFAULT_MODE).csv(path)
    return True


def register(df: DataFrame, name: str) -> DataFrame:
    """Make `df` available to SQL text under `name`."""
    df.createOrReplaceTempView(name)
    return df
