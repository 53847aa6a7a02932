"""Log lines and log pages.

Lines are rows (run_id, pos, line), numbered from 0 in each run; pages are rows
(run_id, from, total, log) where `log` holds the lines from `from` on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.functions.text import quote_name, unescape_newlines
from runlens.operators.skew import HOT_PART, MIN_HOT_ROWS, heavy_keys

# Fixed value: lines per log page.
PAGE_LINES = 100

# Pages that overlap meet in blocks of so many line numbers: of a run of any length, never
# more than a block is in one place. Blocks that carry the lines themselves are smaller.
SPAN_BLOCK, LINE_BLOCK = 1 << 16, 1 << 12

# Values of the order that are looked at for each part of a run that holds many rows.
SAMPLED = 64


def split_lines(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per line of a text column: the `keep` columns, `pos`, `line`."""
    return df.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))


def unescape_lines(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Turn escaped line breaks into real ones, then one row per line."""
    return split_lines(df.withColumn(text, unescape_newlines(text)), text, keep)


def paginate_lines(lines: DataFrame, size: int = PAGE_LINES) -> DataFrame:
    """Pages of `size` lines: (run_id, from, log).

    The page is computed from the line number, so a group never holds more than
    `size` lines however long the log is.
    """
    page = F.floor(F.col("pos") / size)
    return (
        lines.groupBy("run_id", page.alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("rows"))
        .select(
            "run_id",
            (F.col("page") * size).alias("from"),
            F.transform("rows", lambda row: row["line"]).alias("log"),
        )
    )


def number_lines(
    lines: DataFrame,
    keys: list[str],
    order: list[str],
    name: str = "pos",
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Add `name`: the number of a line among those of its keys, from 0 on, in the given order.

    Lines that the order does not tell apart are put in an order of their own, by a hash of
    the whole row. NULL keys are keys like others; NULLs in the order come first.

    A window numbers the lines of ordinary keys. A key with a large part of all lines is cut
    into ranges of the order, one for each part of it that fits a task; ranges are numbered
    apart, and the counts of earlier ranges are added. Where to cut is estimated from some
    lines of such keys; what comes out is exact wherever that is. A few numbers for each
    range are all that is broadcast, and ranges are no more than a few for each task.
    """
    of = lambda names: [F.col(quote_name(x)) for x in names]
    place = F.struct(*of(order), F.xxhash64(*of(lines.columns)).alias("_tie"))
    key = F.xxhash64(*of(keys))
    placed = lines.withColumn("_key", key).withColumn("_place", place)
    heavy = heavy_keys(placed, "_key", hot_part, min_hot_rows)
    # The cuts of a key, in groups of about as many as there are groups, so that finding a
    # line's range looks at two short lists.
    rate = F.greatest(F.lit(1), (F.col("share") / SAMPLED).cast("bigint"))
    sampled = placed.join(F.broadcast(heavy), "_key").filter(F.pmod(F.xxhash64("_place"), rate) == 0)
    step = F.size("_some") / F.col("n_salts")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("n_salts") - 1),
        lambda i: F.element_at("_some", F.greatest(F.lit(1), F.ceil(i * step).cast("int"))),
    )
    wide = F.ceil(F.sqrt(F.size("_cuts"))).cast("int")
    grouped = F.transform(
        F.sequence(F.lit(0), F.size("_cuts") - 1, F.col("_wide")),
        lambda i: F.slice("_cuts", i + 1, F.col("_wide")),
    )
    ranges = (
        sampled.groupBy("_key")
        .agg(F.array_sort(F.collect_list("_place")).alias("_some"), F.first("n_salts").alias("n_salts"))
        .filter("n_salts > 1 AND size(_some) > 0")
        .select("_key", cuts.alias("_cuts"))
        .withColumn("_wide", wide)
        .select("_key", "_wide", grouped.alias("_groups"))
        .withColumn("_lasts", F.transform("_groups", lambda g: F.element_at(g, -1)))
    )
    group = F.size(F.filter("_lasts", lambda cut: cut < F.col("_place")))
    within = F.size(F.filter(F.get("_groups", F.col("_group")), lambda cut: cut < F.col("_place")))
    in_range = F.col("_group") * F.col("_wide") + F.greatest(within, F.lit(0))

    def dealt(how: str) -> DataFrame:
        joined = placed.join(F.broadcast(ranges), "_key", how)
        return joined.withColumn("_group", group).withColumn("_range", F.coalesce(in_range, F.lit(0)))

    counts = dealt("inner").groupBy("_key", "_range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_key", "_range", F.sum("n").over(earlier).alias("_before"))
    number = F.row_number().over(Window.partitionBy(*of(keys), "_range").orderBy("_place"))
    numbered = dealt("left").join(F.broadcast(before), ["_key", "_range"], "left")
    return numbered.select(
        *of(lines.columns),
        (number + F.coalesce("_before", F.lit(0)) - 1).cast("bigint").alias(name),
    )


def paginate(
    lines: DataFrame,
    keys: list[str],
    order: list[str],
    size: int = PAGE_LINES,
    line: str = "line",
    hot_part: float = HOT_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Pages of `size` lines that have no number, only an order: (*keys, from, log).

    As `paginate_lines`, a group never holds more than `size` lines.
    """
    numbered = number_lines(lines, keys, order, "_pos", hot_part, min_hot_rows)
    page = F.floor(F.col("_pos") / size)
    names = [F.col(quote_name(x)) for x in keys]
    return (
        numbered.groupBy(*names, page.alias("_page"))
        .agg(F.array_sort(F.collect_list(F.struct("_pos", F.col(quote_name(line)).alias("_line")))).alias("_rows"))
        .select(
            *names,
            (F.col("_page") * size).alias("from"),
            F.transform("_rows", lambda row: row["_line"]).alias("log"),
        )
    )


def page_counts(lines: DataFrame, runs: DataFrame | None = None, size: int = PAGE_LINES) -> DataFrame:
    """Fetches needed per run; an empty log still costs one.

    Runs without a line appear only if `runs` (run_id) is given.
    """
    counts = lines.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_lines"))
    if runs is not None:
        counts = runs.select("run_id").join(counts, "run_id", "left")
    n_lines = F.coalesce("n_lines", F.lit(0))
    return counts.select(
        "run_id",
        n_lines.alias("n_lines"),
        F.greatest(F.lit(1), F.ceil(n_lines / size)).alias("n_pages"),
    )


def _page_malformed() -> Column:
    return F.col("log").isNull() | F.col("from").isNull() | (F.col("from") < 0) | F.col("total").isNull()


def _blocks(begin: Column, end: Column, block: int) -> Column:
    """The blocks that lines from `begin` to before `end` lie in; an empty page has one too."""
    return F.sequence(F.floor(begin / block), F.floor(F.greatest(begin, end - 1) / block))


def _reach() -> Column:
    """How far the pieces before a row reach without counting itself, from its block's start on.

    A running maximum over the pieces of one block of one run, which are no more than its
    lines. Of pieces that begin together the longest goes first.
    """
    pieces = Window.partitionBy("run_id", "block").orderBy("begin", F.desc("end"))
    before = pieces.rowsBetween(Window.unboundedPreceding, -1)
    ends = F.max(F.when(F.col("end") > F.col("begin"), F.col("end"))).over(before)
    return F.coalesce(ends, F.col("first"))


def assemble_pages(pages: DataFrame) -> DataFrame:
    """Lines of all well-formed pages with their number: (run_id, pos, line).

    Every line that some page holds comes out once. Where pages overlap, the one that
    begins first gives the line, and of those at one offset the longest.

    Pages are cut at blocks of line numbers, and each piece leaves out what the pieces of
    its block before it hold already; so a repeated page or a long log meets no more than a
    block of lines.
    """
    best = F.max(F.struct(F.size("log").alias("n"), "total", "log")).alias("page")
    once = pages.filter(~_page_malformed()).groupBy("run_id", "from").agg(best)
    begin, end = F.col("from").cast("bigint"), F.col("from").cast("bigint") + F.col("page.n")
    # A page within one block, as nearly all are, is not cut.
    cut = once.select("run_id", begin.alias("from"), end.alias("to"), F.col("page.log").alias("log")).filter("to > from")
    cut = cut.withColumn("block", F.explode(_blocks(F.col("from"), F.col("to"), LINE_BLOCK)))
    first = F.col("block") * LINE_BLOCK
    pieces = (
        cut.withColumn("first", first)
        .withColumn("begin", F.greatest("from", "first"))
        .withColumn("end", F.least(F.col("to"), F.col("first") + LINE_BLOCK))
        .withColumn("fresh", F.greatest(F.col("begin"), _reach()))
        .filter("end > fresh")
    )
    fresh = F.slice("log", (F.col("fresh") - F.col("from") + 1).cast("int"), (F.col("end") - F.col("fresh")).cast("int"))
    whole = (F.col("fresh") == F.col("from")) & (F.col("end") == F.col("to"))
    return pieces.select(
        "run_id", "fresh", F.posexplode(F.when(whole, F.col("log")).otherwise(fresh)).alias("offset", "line")
    ).select("run_id", (F.col("fresh") + F.col("offset")).alias("pos"), "line")


def page_status(pages: DataFrame) -> DataFrame:
    """How far each run's pages reach: (run_id, n_pages, n_lines, next_from, status).

    `n_pages` counts all pages, `n_lines` the line numbers that well-formed ones hold,
    however often; `next_from` is the first number, from 0 on, that none of them holds.
    `malformed` if a page lacks its log, offset or total, or has an offset below 0;
    `complete` if `next_from` reaches the total; `stalled` if a page without lines begins
    there, since the next fetch would ask for the same offset again; else `incomplete`, to
    go on from `next_from`.

    A union of intervals: pieces of pages meet by blocks of line numbers, in which a running
    maximum tells what is covered and where the first hole is; a run then looks through its
    blocks only.
    """
    well = ~_page_malformed()
    begin = F.when(well, F.col("from").cast("bigint"))
    spans = pages.select(
        "run_id", begin.alias("from"), (begin + F.size("log")).alias("to"), F.when(well, F.col("total")).alias("total")
    )
    cut = spans.withColumn("block", F.explode_outer(_blocks(F.col("from"), F.col("to"), SPAN_BLOCK)))
    first = F.col("block") * SPAN_BLOCK
    starts_here = F.col("block").isNull() | (F.col("from") >= first)
    pieces = cut.select(
        "run_id",
        "block",
        F.greatest("from", first).alias("begin"),
        F.least(F.col("to"), first + SPAN_BLOCK).alias("end"),
        starts_here.cast("bigint").alias("n_pages"),
        "total",
    )
    # A page that was fetched many times is one piece from here on.
    pieces = (
        pieces.groupBy("run_id", "block", "begin")
        .agg(
            F.max("end").alias("end"),
            F.sum("n_pages").alias("n_pages"),
            F.max("total").alias("total"),
        )
        .withColumn("first", first)
        .withColumn("reach", _reach())
    )
    last = F.greatest(F.max("end"), F.max("first"))
    gap = F.when(F.col("begin") > F.col("reach"), F.col("reach"))
    stuck = (F.col("end") <= F.col("begin")) & (F.col("begin") == F.col("reach"))
    blocks = pieces.groupBy("run_id", "block").agg(
        F.sum("n_pages").alias("n_pages"),
        F.max("total").alias("total"),
        F.sum(F.greatest(F.col("end") - F.greatest("begin", "reach"), F.lit(0))).alias("n_lines"),
        F.coalesce(F.min(gap), last).alias("held"),
        F.min(F.when(stuck, F.col("begin"))).alias("stuck"),
    )
    following = F.lead("block").over(Window.partitionBy("run_id").orderBy(F.asc_nulls_first("block")))
    is_full = F.col("held") == first + SPAN_BLOCK
    goes_on = is_full & F.coalesce(F.col("following") == F.col("block") + 1, F.lit(False))
    per_run = (
        blocks.withColumn("following", following)
        .groupBy("run_id")
        .agg(
            F.sum("n_pages").alias("n_pages"),
            F.coalesce(F.sum("n_lines"), F.lit(0)).alias("n_lines"),
            F.max("total").alias("total"),
            F.bool_or(F.col("block").isNull()).alias("bad"),
            F.min("block").alias("lowest"),
            F.min(F.when(~goes_on, F.col("held"))).alias("hole"),
            F.min("stuck").alias("stuck"),
        )
        .withColumn("next_from", F.when(F.col("lowest") > 0, F.lit(0)).otherwise(F.col("hole")))
    )
    return per_run.select(
        "run_id",
        "n_pages",
        "n_lines",
        "next_from",
        F.when(F.col("bad"), "malformed")
        .when(F.col("next_from") >= F.col("total"), "complete")
        .when(F.col("next_from") == F.col("stuck"), "stalled")
        .otherwise("incomplete")
        .alias("status"),
    )
