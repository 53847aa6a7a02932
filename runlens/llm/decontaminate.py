"""Benchmark passages in documents, also with other numbers, names and units.

Texts are brought to a template: letters in lower case, numbers and the units behind
them replaced by typed placeholders, and in a second template capitalised words inside
a sentence as well. Windows of both templates are hashed and joined; those with few
words besides placeholders are hashed with their values, so exact copies of them meet
too. In a second form of the text neighbouring capitalised words are one name, also
at the start of a sentence, so names there and those of several words can differ. Where document
and benchmark agree in a run of windows, the values behind the placeholders must
correspond one to one; then it is the same question, perhaps with other values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.shared import pick, stored, text_batches, texts_of
from runlens.llm.words import DIGIT, LETTER, is_capital, mixed, tokens_of, windows

# Words of a window, and how many of an item's words must be matched (all, if it has fewer).
WORDS = 8
COVERED = 13
# Items of fewer words are found anywhere by chance, and count only as a whole line or sentence.
LEAST_WORDS = 5
# Least share of a window that must not be placeholders; others are compared by their values.
LITERAL = 0.5
# Bits of the filter that documents' windows pass first; it has this size always.
FILTER_BITS = 26

# Units of measure as written after numbers.
UNITS = (
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz pound pounds "
    "ounce ounces gram grams kilogram kilograms ml cl l litre litres liter liters gallon gallons s sec second "
    "seconds min minute minutes h hr hour hours day days week weeks month months year years percent euro euros "
    "dollar dollars cent cents usd eur gbp meter meters metre metres kilometer kilometers kilometre kilometres "
    "kmh mph km2 m2 m3 w kw kwh j kj cal kcal v a hz khz mhz ghz kb mb gb tb"
).split()

_NUMBER, _UNIT, _NAME, _RAW = (mixed(np.array([x], np.uint64))[0] for x in (1001, 1002, 1003, 1004))
_units: list[np.ndarray] = []


def _is_unit(hashes: np.ndarray) -> np.ndarray:
    if not _units:
        (_, found), = tokens_of([" ".join(UNITS)], lower=True)
        _units.append(np.unique(found.hashes))
    return np.isin(hashes, _units[0])


def templates(texts: list[str]):
    """The words of each text, marks left out, as both templates."""
    for _, found in tokens_of(texts, lower=True):
        word = (found.kinds == LETTER) | (found.kinds == DIGIT)
        number = found.kinds == DIGIT
        ends = np.isin(found.points, np.array([ord(c) for c in ".!?:\n"], np.uint32))
        # Sentence ends before each token; a point inside a number is none.
        before = np.concatenate([[0], np.cumsum(ends)])[found.starts]
        line = np.concatenate([[0], np.cumsum(found.points == 10)])[found.starts]
        place = np.flatnonzero(word)
        starts, stops, hashes = found.starts[place], found.ends[place], found.hashes[place]
        raw, hashes = hashes, hashes.copy()
        number, before, line = number[place], before[place], line[place]
        after_number = np.concatenate([[False], number[:-1]])
        unit = after_number & ~number & _is_unit(hashes)
        hashes[number], hashes[unit] = _NUMBER, _UNIT
        inner = np.concatenate([[False], before[1:] == before[:-1]])
        capital = is_capital(found.points[starts]) & ~is_capital(found.points[stops - 1]) & (stops - starts > 1)
        name = inner & capital & ~number & ~unit
        start = ~inner & capital & ~number & ~unit
        # Neighbouring capitalised words of a sentence are one in the second form.
        beside = np.concatenate([[False], place[1:] == place[:-1] + 1])
        capital = name | start
        heads = np.flatnonzero(~(name & beside & np.concatenate([[False], capital[:-1]])))
        tails = np.append(heads[1:], len(place)) - 1
        alone = start[heads] & (heads == tails)
        joined = hashes[heads]
        joined_named = np.where(capital[heads], _NAME, joined)
        joined_inner = np.where(capital[heads] & ~alone, _NAME, joined)
        named = hashes.copy()
        named[name] = _NAME
        first = np.searchsorted(place, found.first)
        first_head = np.searchsorted(heads, first)
        for i in range(len(found.first) - 1):
            part = slice(first[i], first[i + 1])
            slots = (number | unit)[part]
            text = _Text(found.text, starts[part], stops[part], hashes[part], named[part], raw[part], slots, name[part])
            text.parts = [before[part], line[part]]
            part = slice(first_head[i], first_head[i + 1])
            head, tail = heads[part], tails[part]
            slots = (number | unit)[head]
            text.joined = _Joined(
                found.text, starts[head], stops[tail], joined_inner[part], joined_named[part], slots, capital[head], alone[part]
            )
            text.joined.words = np.append(head, first[i + 1]) - first[i]
            yield text


class _Text:
    """One text's words: where they stand, both templates and the words, and which are placeholders.

    `parts` has the number of each word's sentence and of its line.
    """

    def __init__(self, text, starts, stops, plain, named, raw, slots, names):
        self.text, self.starts, self.stops = text, starts, stops
        self.plain, self.named, self.raw, self.slots, self.names = plain, named, raw, slots, names

    def windows(self, size: int):
        """(position, hash, with names) of every window; one of few literal words has its values hashed."""
        n = len(self.plain) - size + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
        most = int(size * (1 - LITERAL))
        sums = np.concatenate([[0], np.cumsum(self.slots)])
        plain = (sums[size:] - sums[:-size]) <= most
        named_sums = np.concatenate([[0], np.cumsum(self.names)])
        some = named_sums[size:] - named_sums[:-size]
        named = (some > 0) & (sums[size:] - sums[:-size] + some <= most)
        kind = np.uint64(size)
        hashes = windows(self.plain, size)
        if not plain.all():
            hashes = np.where(plain, hashes, windows(self.raw, size) ^ _RAW)
        b = np.flatnonzero(named)
        hashes = np.concatenate([hashes, windows(self.named, size)[b]]) ^ mixed(np.array([kind]))
        return np.concatenate([np.arange(n), b]), hashes, np.repeat([False, True], [n, len(b)])

    def whole(self, size: int):
        """(position, hash, False) of every line or sentence of so many words, by the words themselves.

        A single word counts as a line only.
        """
        at = [np.zeros(0, np.int64)]
        for part in self.parts if size > 1 else self.parts[1:]:
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            at.append(starts[np.diff(starts, append=len(part)) == size])
        at = np.unique(np.concatenate(at))
        hashes = windows(self.raw, size)[at] if len(at) else np.zeros(0, np.uint64)
        return at, hashes ^ mixed(np.array([size + 512], np.uint64)), np.zeros(len(at), bool)

    def values(self, at: int, size: int, with_names: bool) -> list[str]:
        """What stands behind the placeholders of a window, as place in it and value."""
        part = slice(at, at + size)
        slots = self.slots[part] | self.names[part] if with_names else self.slots[part]
        if not with_names and slots.sum() > int(size * (1 - LITERAL)):  # its values are hashed and agree
            slots = np.zeros(size, bool)
        return [
            f"{k}\t{self.text[self.starts[at + k] : self.stops[at + k]].lower()}" for k in np.flatnonzero(slots).tolist()
        ]


class _Joined(_Text):
    """The second form: a run of names is one word; at a sentence's start one word alone may be none.

    `words` has the first word of each and the end.
    """

    def __init__(self, text, starts, stops, plain, named, slots, names, alone):
        super().__init__(text, starts, stops, plain, named, plain, slots, names)
        self.alone = alone

    def windows(self, size: int):
        """(position, hash, with words alone at a sentence's start as names) of every window with enough literal words."""
        n = len(self.plain) - size + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
        most = int(size * (1 - LITERAL))
        sums = np.concatenate([[0], np.cumsum(self.slots | self.names)])
        found = sums[size:] - sums[:-size]
        sums = np.concatenate([[0], np.cumsum(self.alone)])
        alone = sums[size:] - sums[:-size]
        a, b = np.flatnonzero(found <= most), np.flatnonzero((alone > 0) & (found - alone <= most))
        hashes = windows(self.named, size)[a]
        if len(b):
            hashes = np.concatenate([hashes, windows(self.plain, size)[b]])
        kind = mixed(np.array([size + 256], np.uint64))
        return np.concatenate([a, b]), hashes ^ kind, np.repeat([True, False], [len(a), len(b)])

    def values(self, at: int, size: int, with_names: bool) -> list[str]:
        part = slice(at, at + size)
        slots = self.slots[part] | (self.names[part] if with_names else self.names[part] & ~self.alone[part])
        return [
            f"{k}\t{self.text[self.starts[at + k] : self.stops[at + k]].lower()}" for k in np.flatnonzero(slots).tolist()
        ]


_WINDOW = "window long, at int, named boolean, size int, slots array<string>, form int, start int, stop int"


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """Every window of every item in both forms; an item of fewer words is one window.

    One of very few words is a window of a third form, which whole lines and sentences have.
    """

    def run(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item_id").to_pylist(), templates(texts_of(batch)), strict=True):
                size, n = min(WORDS, len(text.plain)), len(text.plain)
                if size >= LEAST_WORDS:
                    for at, window, named in zip(*(x.tolist() for x in text.windows(size)), strict=True):
                        slots = text.values(at, size, named)
                        out.append((item, n, window, at, named, size, slots, 0, at, at + size))
                elif size:
                    window = int(windows(text.raw, size)[0] ^ mixed(np.array([size + 512], np.uint64))[0])
                    out.append((item, n, window, 0, False, size, [], 2, 0, size))
                joined = text.joined
                size = min(WORDS, len(joined.plain))
                if size >= LEAST_WORDS and joined.names.any():
                    for at, window, named in zip(*(x.tolist() for x in joined.windows(size)), strict=True):
                        start, stop = int(joined.words[at]), int(joined.words[at + size])
                        slots = joined.values(at, size, named)
                        out.append((item, n, window, at, named, size, slots, 1, start, stop))
            yield _batch(out, ["item_id", "n_words"], [pa.int64(), pa.int32()])

    return benchmark.mapInArrow(run, f"item_id long, n_words int, {_WINDOW}")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    names = [*names, "window", "at", "named", "size", "slots", "form", "start", "stop"]
    kinds = [*kinds, pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.list_(pa.string()), *[pa.int32()] * 3]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    at = names.index("window")
    columns[at] = np.array(columns[at], np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _filter(items: DataFrame) -> np.ndarray:
    """A bit for each of 2^FILTER_BITS classes of windows that some item has."""
    place = F.col("window").bitwiseAND((1 << FILTER_BITS) - 1)
    word, bit = F.shiftrightunsigned(place, 6).alias("word"), F.pmod(place, F.lit(64)).cast("int")
    bits = items.select(word, F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    rows = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    made = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    made[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return made.view(np.uint64)


def _document_windows(docs: DataFrame, bits, sizes: list[tuple[int, int]]) -> DataFrame:
    """The windows of every document that may be an item's."""
    mask = np.uint64((1 << FILTER_BITS) - 1)

    def run(batches):
        for batch in batches:
            out = []
            ids, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            for name, row, text in zip(ids, rows, templates(texts_of(batch)), strict=True):
                for form, size in sizes:
                    of = text.joined if form == 1 else text
                    at, found, named = of.whole(size) if form == 2 else of.windows(size)
                    place = found & mask
                    hit = bits.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1
                    for k, window, n in zip(at[hit].tolist(), found[hit].tolist(), named[hit].tolist(), strict=True):
                        start, stop = (int(of.words[k]), int(of.words[k + size])) if form == 1 else (k, k + size)
                        slots = [] if form == 2 else of.values(k, size, n)
                        out.append((name, row, window, k, n, size, slots, form, start, stop))
            yield _batch(out, ["doc_id", "row"], [pa.int64(), pa.int64()])

    return docs.mapInArrow(run, f"doc_id long, row long, {_WINDOW}")


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, row, item_id, ...) for each item that stands in a document; `docs` has a row hash."""
    spark = docs.sparkSession
    items = stored(_item_windows(benchmark), "item-windows")
    sizes = sorted((r["form"], r["size"]) for r in items.select("form", "size").distinct().collect())
    bits = spark.sparkContext.broadcast(_filter(items))
    theirs = items.withColumnsRenamed({"at": "item_at", "slots": "item_slots", "start": "item_start", "stop": "item_stop"})
    met = _document_windows(docs, bits, sizes).join(theirs.drop("named", "size"), ["window", "form"])
    met = met.withColumn("diagonal", F.col("at") - F.col("item_at"))

    # Windows in one line: how many words they cover, and what stands behind placeholders.
    line = ["doc_id", "row", "item_id", "n_words", "form", "diagonal"]
    once = met.groupBy(*line, "item_at").agg(
        F.min("item_start").alias("begin"),
        F.max("item_stop").alias("end"),
        F.min(F.col("start") - F.col("item_start")).alias("shift"),
        F.max_by(F.arrays_zip("item_slots", "slots"), F.col("named").cast("int")).alias("pairs"),
    )
    order = Window.partitionBy(*line).orderBy("item_at")
    covered = once.withColumn("new", F.least(F.lead("begin").over(order), F.col("end")) - F.col("begin"))
    value = lambda x: F.substring_index(x, "\t", -1)
    pairs = F.transform("pairs", lambda x: F.struct(value(x["item_slots"]).alias("x"), value(x["slots"]).alias("y")))
    found = covered.groupBy(*line).agg(
        F.sum("new").alias("covered"),
        F.min("shift").alias("low"),
        F.max("shift").alias("high"),
        F.array_distinct(F.flatten(F.collect_list(pairs))).alias("pairs"),
    )
    n = F.size("pairs")
    one_to_one = (F.size(F.array_distinct("pairs.x")) == n) & (F.size(F.array_distinct("pairs.y")) == n)
    enough = F.col("covered") >= F.least(F.lit(COVERED), F.col("n_words"))
    changed = F.exists("pairs", lambda x: x["x"] != x["y"])
    found = found.where(one_to_one & enough).withColumn("changed", changed)
    found = found.groupBy("doc_id", "row", "item_id", "n_words").agg(
        F.max("covered").alias("covered"),
        F.collect_list(F.struct("form", "low", "high")).alias("lines"),
        F.min("changed").alias("changed"),
    )
    # A place that both forms have found counts once.
    twice = lambda x: F.exists("lines", lambda y: (y["form"] == 0) & y["low"].between(x["low"], x["high"]))
    places = F.size(F.filter("lines", lambda x: (x["form"] == 0) | ~twice(x))).cast("long")
    return found.select("doc_id", "row", "item_id", "n_words", "covered", places.alias("places"), "changed")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Items that stand in documents: doc_id, item_id, n_words, covered, places, changed.

    `covered` is how many of the item's `n_words` words the best place has, at least
    COVERED or all; `places` at how many places; `changed` whether every place has other
    values. Documents without any give no row. NULL, empty and wordless texts match nothing;
    items of fewer than LEAST_WORDS words match lines and sentences that have just these words, and
    an item of one word lines only. A NULL doc_id or item_id is kept; rows that agree in doc_id and text
    count once, and so do equal items with one id. Other columns are ignored.

    Documents are read once, whole; only windows that pass a filter of fixed size are
    joined, by shuffle or broadcast as Spark sees fit, whatever the benchmark's size.
    """
    return _leaks(_plain(docs), pick(benchmark, item_id="long", text="string").distinct()).drop("row")


def _plain(docs: DataFrame) -> DataFrame:
    text_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, in which no item stands."""
    found = _leaks(_plain(docs), pick(benchmark, item_id="long", text="string").distinct())
    found = stored(found.select("doc_id", "row").distinct(), "leaks")
    return docs.alias("d").join(
        found.alias("f"),
        F.col("d.doc_id").cast("long").eqNullSafe(F.col("f.doc_id"))
        & (F.xxhash64(F.col("d.text").cast("string")) == F.col("f.row")),
        "left_anti",
    )
