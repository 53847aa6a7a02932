"""Joining rows to a per-key table when a few keys hold a large part of the rows.

Spark's own skew handling splits a join side only if it comes straight from a
shuffle and nothing after the join needs the rows grouped by the same key. The
joins here are built from aggregates, or feed one, so rows of hot keys are dealt out
explicitly: each gets one of as many salts as its key needs tasks, and the few hot
rows of the per-key table are repeated for every salt.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A task's fair share is the rows over the shuffle partitions. A key is hot from this
# part of it on, so no task gets more than its share and about as much again.
HOT_PART = 0.5
# Below this many rows a key fits one task, whatever its share.
MIN_HOT_ROWS = 1_000_000
# Rows that one task joins, if it is known how many there are: a join of more rows has
# more tasks, and what one of them sorts in memory stays as it is.
TASK_ROWS = 250_000
# Parts for each task that rows without a key are dealt in.
NULL_SALTS = 100
# Keys are counted in groups, each with a summary of at most so many keys, which finds
# every key with a 512th of its group's rows. There are as many groups as it takes to
# find keys with half a task's share.
TRACKED_KEYS = 512
TOP_KEYS = 256
LEAST_GROUPS = 32


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_sketch(rows: DataFrame, key: str) -> DataFrame:
    """A summary of how often each key occurs: a few rows, that can be merged with others.

    Reads the key column only; rows without a key don't count. Counts are frequent-item
    summaries, which never shuffle the keys themselves; they are off by less than a
    hundredth of the rows of a key's group.
    """
    groups = max(LEAST_GROUPS, -(-_partitions(rows) // 64))
    group = F.pmod(F.xxhash64(key), F.lit(groups))
    return (
        rows.filter(F.col(key).isNotNull())
        .groupBy(group.alias("_group"))
        .agg(
            F.expr(f"approx_top_k_accumulate(`{key}`, {TRACKED_KEYS})").alias("_sketch"),
            F.count(F.lit(1)).alias("_n"),
        )
    )


def merged_sketches(*sketches: DataFrame) -> DataFrame:
    """The summary of the rows of all of them; their keys are of one type."""
    every = sketches[0]
    for sketch in sketches[1:]:
        every = every.unionByName(sketch)
    return every.groupBy("_group").agg(
        F.expr(f"approx_top_k_combine(_sketch, {TRACKED_KEYS})").alias("_sketch"), F.sum("_n").alias("_n")
    )


def keys_of_sketch(
    sketch: DataFrame, key: str, hot_part: float = HOT_PART, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """(key, n_salts, share): keys with at least `hot_part` of a task's share of the rows, in
    how many parts to deal them, and about how many rows make a part.

    Counts are close enough for that: they decide where rows are joined, not what they
    join with. Shares add up to one, so there are at most partitions / `hot_part` hot keys,
    and not many more salts, whatever the size of the input.
    """
    n_all = F.sum("_n").over(Window.partitionBy(F.lit(0)))
    share = F.greatest(F.col("_n_all") * F.lit(hot_part) / _partitions(sketch), F.lit(min_hot_rows))
    return (
        # A window over the few groups, not over the rows.
        sketch.withColumn("_n_all", n_all)
        .select("_n_all", F.inline(F.expr(f"approx_top_k_estimate(_sketch, {TOP_KEYS})")))
        .filter(F.col("count") >= share)
        .select(
            F.col("item").alias(key),
            F.ceil(F.col("count") / share).alias("n_salts"),
            share.cast("bigint").alias("share"),
        )
    )


def heavy_keys(
    rows: DataFrame, key: str, hot_part: float = HOT_PART, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """(key, n_salts, share), as `keys_of_sketch` gives them, of some rows."""
    return keys_of_sketch(key_sketch(rows, key), key, hot_part, min_hot_rows)


def hot_keys(
    rows: DataFrame, key: str, hot_part: float = HOT_PART, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """(key, n_salts): the keys of `heavy_keys`, and in how many parts to deal them."""
    return heavy_keys(rows, key, hot_part, min_hot_rows).select(key, "n_salts")


@dataclass(frozen=True)
class HotKeys:
    """The hot keys of some rows, found once for all joins of a plan that go by this key.

    At most a few for each task, so that they are kept here and go with the plan. Keys
    that have become hot since, or rows that were not looked at, make a join slower and
    never wrong. The same holds for `n_rows`, which tells how many tasks a join needs.
    """

    kind: T.DataType
    keys: tuple[tuple, ...]
    n_rows: int = 0

    @staticmethod
    def find(*rows: DataFrame, key: str, hot_part: float = HOT_PART, min_hot_rows: int = MIN_HOT_ROWS) -> HotKeys:
        """Reads the key column of each of `rows` once, now, and counts their rows."""
        sketch = merged_sketches(*(key_sketch(x, key) for x in rows)) if len(rows) > 1 else key_sketch(rows[0], key)
        hot = keys_of_sketch(sketch, key, hot_part, min_hot_rows).select(key, "n_salts")
        found = tuple(tuple(x) for x in hot.collect())
        return HotKeys(rows[0].schema[key].dataType, found, sum(x.count() for x in rows))

    def frame(self, like: DataFrame, key: str) -> DataFrame:
        schema = T.StructType([T.StructField(key, self.kind), T.StructField("n_salts", T.LongType())])
        return like.sparkSession.createDataFrame(list(self.keys), schema)


def split_join(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    how: str = "left",
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Join `rows` to `per_key` on `key` with hot keys dealt out; nothing is dropped.

    `per_key` must hold one row per key, as an aggregate does: so little of it is
    repeated. `how`: inner, left, left_semi or left_anti. Rows without a key match
    nothing and are spread over all tasks. The rows are read once for their keys, unless
    `hot` has them already, and once for the join. With `hot` there are as many tasks as
    its rows need, if that is more than the shuffle partitions.
    """
    n_tasks = -(-hot.n_rows // TASK_ROWS) if hot is not None else 0
    n_tasks = n_tasks if n_tasks > _partitions(rows) else None

    def dealt(side: DataFrame) -> DataFrame:
        return side.repartition(n_tasks, key, "_salt") if n_tasks else side

    # As few salts as tasks would leave some tasks none of them and others several.
    spread = F.when(F.col(key).isNull(), F.lit((n_tasks or _partitions(rows)) * NULL_SALTS))
    if how in ("inner", "left_semi"):
        rows = rows.filter(F.col(key).isNotNull())
    turn = F.xxhash64(F.monotonically_increasing_id())
    if hot is not None and not hot.keys:
        salted = rows.withColumn("_salt", F.pmod(turn, F.coalesce(spread, F.lit(1))))
        # Always 0, and no constant: Spark takes that out of the keys of the join, so that all
        # rows without a key would meet in one task.
        once = per_key.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1)))
        return dealt(salted).join(dealt(once), [key, "_salt"], how).drop("_salt")
    found = hot_keys(rows, key, hot_part, min_hot_rows) if hot is None else hot.frame(rows, key)
    found = F.broadcast(found)
    parts = F.coalesce(F.col("n_salts"), spread, F.lit(1))
    salted = rows.join(found, key, "left").withColumn("_salt", F.pmod(turn, parts))
    salts: Column = F.sequence(F.lit(0).cast("bigint"), F.coalesce("n_salts", F.lit(1)).cast("bigint") - 1)
    repeated = per_key.join(found, key, "left").withColumn("_salt", F.explode(salts)).drop("n_salts")
    return dealt(salted.drop("n_salts")).join(dealt(repeated), [key, "_salt"], how).drop("_salt")
