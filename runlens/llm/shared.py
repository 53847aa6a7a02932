"""Tables in the shared folder, bounded Arrow batches, and input clean-up."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.session import remove_at_end, scratch_path

# Rows of text handed to Python at once; Spark's own byte limit holds besides.
TEXT_ROWS = 512


def text_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts holds, unless the session asks for less."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


# Shuffle partitions that go into one file of a table of a few numbers a row.
NARROW = 8


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`df` written to the shared folder and read back, and where it is; removed at the end at the latest."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    remove_at_end(spark, path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Removes a table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends there.

    Tables of a few numbers a row, told by `narrow`, get fewer and larger files.

    Every executor reads the files, so the loss of one costs nothing. They are
    removed when the application ends.
    """
    if narrow:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.coalesce(max(1, -(-partitions // NARROW)))
    return written(df, name)[0]


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns, cast; everything else is left behind.

    Operators work on what they need only, so extra columns of any name cannot
    clash with their own.
    """
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()))


def texts_of(batch, column: str = "text") -> list[str]:
    """The column as Python strings, NULL as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def runs_of(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of neighbours whose sizes sum up to `most`, one element at least."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))
