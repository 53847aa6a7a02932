from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from runlens.functions.text import path_safe, quote_name, tag_text, unescape_newlines
from runlens.operators import logs
from tests.conftest import rows


def value(spark, text, function):
    return spark.createDataFrame([(text,)], "t STRING").select(function("t")).first()[0]


def test_path_safe(spark):
    assert value(spark, "run 4:05:06", path_safe) == "run 4-05-06"
    assert value(spark, None, path_safe) is None


def test_unescape_newlines(spark):
    assert value(spark, "a\\nb\\n", unescape_newlines) == "a\nb\n"
    assert value(spark, "a\nb\\t", unescape_newlines) == "a\nb\\t"


def test_quote_name():
    assert quote_name("a b") == "`a b`" and quote_name("`a b`") == "`a b`" and quote_name("a`b") == "`a``b`"


@pytest.mark.parametrize(
    "html,expected",
    [
        ("<html><pre>out\nput</pre></html>", "out\nput"),
        ("<PRE class='x'>text</PRE>", "text"),
        ("<p>none</p>", None),
        ("<pre></pre>", None),
        ("<pre>one</pre><pre>two</pre>", "two"),
        ("<pre>one</pre><pre></pre>", "one"),
        ("<pre>a<b>c</b>d</pre>", "c"),
        ("<pre>a<b></b>d</pre>", "a"),
        ("<pre>a<br/>b</pre>", "a"),
        ("<pre>a<br>b</pre>", "b"),
        ("<pre>never closed", "never closed"),
        ("<pre/>after", None),
        ('<pre title="a>b">x</pre>', "x"),
        ("<pre title='a/>b' id=c>x<i title=\"d>e\">y</i></pre>", "y"),
        ('<pre title="a"/>after', None),
        ("<prefix>x</prefix>", None),
        ("<!-- <pre>hidden</pre> --><p>x</p>", None),
        ("<pre>a<!-- c -->b</pre>", "b"),
        ('<script>var a="<pre>no</pre>";</script>', None),
        ('<pre>yes</pre><SCRIPT type="a>b">var a="<pre>no</pre>";</SCRIPT >', "yes"),
        ("<pre>a<script>x &amp; <b></script>b</pre>", "x &amp; <b>"),
        ("<style>p::after{content:'<pre>'}</style>text", None),
        ("<style/><pre>a</pre><script/><pre>b</pre>", "b"),
        ("<pre>a</pre><script>never closed <pre>b", "a"),
        ("<script>a</scripts><pre>b</pre></script><pre>c</pre>", "c"),
        ("<pre>a</pre><![CDATA[<pre>b</pre>]]>", "a"),
        ("<pre>a</pre><!-- <script> --><pre>b</pre>", "b"),
        ("<pre>a</pre><!-- not ended <pre>b</pre>", "a"),
        ("<!DOCTYPE html><?xml <pre>?><pre>a</pre>", "a"),
        ("<pre>a</3>b</pre>", "b"),
        ("<pre>1 &lt; 2 &amp;&amp; &quot;x&quot; &#39;y&#39; &amp;lt;</pre>", "1 < 2 && \"x\" 'y' &lt;"),
        (None, None),
    ],
)
def test_tag_text(spark, html, expected):
    assert value(spark, html, tag_text) == expected


class Model(HTMLParser):
    """What the standard library's parser sees: kinds of events, in order."""

    def __init__(self, text):
        super().__init__()
        self.events = []
        self.feed(text)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.events.append(("open", tag))

    def handle_endtag(self, tag):
        self.events.append(("close", tag))

    def handle_data(self, data):
        self.events.append(("text", data))

    def last_text(self, tag):
        found = None
        for i, (kind, text) in enumerate(self.events):
            before = [e for e in self.events[:i] if e[0] == "close" or e == ("open", tag)]
            if kind == "text" and before and before[-1][0] == "open":
                found = text
        return found


def test_tag_text_equals_the_standard_parser(spark):
    rng = random.Random(7)
    parts = ["<pre>", "</pre>", "<b>", "</b>", "<br/>", "<pre/>", "<PRE a='>'>", "<script>", "</script>", "<style>", "</style>"]
    parts += ["text", "&amp;", "&lt;", "<!-- <pre> -->", "<!-- x -->", "line\n", '<i title="</pre>">', "'", "<!DOCTYPE x>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) + "</script></style>" for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    found = {r.i: (r.pre, r.script) for r in df.select("i", tag_text("t").alias("pre"), tag_text("t", "script").alias("script")).collect()}
    for i, text in enumerate(texts):
        model = Model(text)
        assert found[i] == (model.last_text("pre"), model.last_text("script")), text


def test_all_entities(spark):
    html = "<pre>&eacute; &#233; &#xe9; &nbsp;&amp;amp; &lt;b&gt;</pre>"
    found = value(spark, html, lambda t: tag_text(t, all_entities=True))
    assert found == "é é é \xa0&amp; <b>"
    assert value(spark, "<p>x</p>", lambda t: tag_text(t, all_entities=True)) is None


def test_tag_text_reads_whole_documents(spark):
    body = "line of a long log\n" * 100_000
    found = value(spark, f"<html>{'<p>x</p>' * 10000}<pre>{body}</pre></html>", tag_text)
    assert found == body


def lines(spark, *sizes):
    runs = spark.createDataFrame(list(enumerate(sizes)), "run_id BIGINT, n INT")
    numbered = runs.filter("n > 0").select("run_id", F.explode(F.expr("sequence(0, n - 1)")).alias("pos"))
    return runs, numbered.withColumn("line", F.concat(F.lit("line "), F.col("pos")))


def test_page_counts(spark):
    runs, log = lines(spark, 7, 100, 300, 321, 0)
    found = logs.page_counts(log, runs)
    assert rows(found) == [(0, 7, 1), (1, 100, 1), (2, 300, 3), (3, 321, 4), (4, 0, 1)]
    assert logs.page_counts(log).count() == 4


def test_paginate_and_assemble_are_inverse(spark):
    _, log = lines(spark, 7, 100, 321)
    pages = logs.paginate_lines(log)
    sizes = rows(pages.select("run_id", "from", F.size("log")))
    assert sizes == [(0, 0, 7), (1, 0, 100), (2, 0, 100), (2, 100, 100), (2, 200, 100), (2, 300, 21)]
    totals = log.groupBy("run_id").agg(F.count(F.lit(1)).alias("total"))
    served = pages.join(totals, "run_id")
    assert rows(logs.assemble_pages(served)) == rows(log)
    assert rows(logs.page_status(served)) == [
        (0, 1, 7, 7, "complete"), (1, 1, 100, 100, "complete"), (2, 4, 321, 321, "complete"),
    ]


def test_page_status(spark):
    pages = spark.createDataFrame(
        [
            (1, 0, 5, ["a", "b"]),
            (2, 0, 5, ["a", "b"]), (2, 2, 5, []),
            (3, 0, 2, ["a"]), (3, None, 2, ["b"]),
            (4, 0, None, ["a"]),
            (5, 0, 1, None),
            (6, 0, 0, []),
            (7, 0, 3, ["a"]), (7, 1, 3, ["b", "c"]),
            (8, 0, 3, ["a"]), (8, 2, 3, ["c"]),
            (9, 0, 3, ["a", "b"]), (9, 0, 3, ["a", "b"]),
            (10, 1, 3, ["b", "c"]),
        ],
        "run_id BIGINT, from BIGINT, total BIGINT, log ARRAY<STRING>",
    )
    found = rows(logs.page_status(pages))
    assert sorted(found) == [
        (1, 1, 2, 2, "incomplete"),
        (2, 2, 2, 2, "stalled"),
        (3, 2, 1, 1, "malformed"),
        (4, 1, 0, None, "malformed"),
        (5, 1, 0, None, "malformed"),
        (6, 1, 0, 0, "complete"),
        (7, 2, 3, 3, "complete"),
        (8, 2, 2, 1, "incomplete"),
        (9, 2, 2, 2, "incomplete"),
        (10, 1, 2, 0, "incomplete"),
    ]
    assert rows(logs.assemble_pages(pages.filter("run_id IN (8, 9)"))) == [
        (8, 0, "a"), (8, 2, "c"), (9, 0, "a"), (9, 1, "b"),
    ]


PAGES = "run_id BIGINT, from BIGINT, total BIGINT, log ARRAY<STRING>"


def text_of(begin, end):
    return [f"line {i}" for i in range(begin, end)]


def test_pages_that_overlap(spark):
    pages = [
        (1, 0, 150, text_of(0, 100)), (1, 50, 150, text_of(50, 150)),
        (2, 0, 150, text_of(0, 100)), (2, 50, 150, text_of(50, 80)), (2, 100, 150, text_of(100, 150)),
        (3, 0, 150, text_of(0, 100)), (3, 50, 150, text_of(50, 120)), (3, 130, 150, text_of(130, 150)),
        (4, 0, 150, text_of(0, 100)), (4, 60, 150, []),  # empty, where another page has lines
        (5, 0, 9, text_of(0, 3)), (5, 3, 9, []), (5, 5, 9, text_of(5, 9)),
        (6, -1, 9, ["x"]), (6, 0, 1, ["a"]),
    ]
    made = spark.createDataFrame(pages, PAGES)
    assert rows(logs.page_status(made)) == [
        (1, 2, 150, 150, "complete"), (2, 3, 150, 150, "complete"), (3, 3, 140, 120, "incomplete"),
        (4, 2, 100, 100, "incomplete"), (5, 3, 7, 3, "stalled"), (6, 2, 1, 1, "malformed"),
    ]
    found = rows(logs.assemble_pages(made.filter("run_id = 1")))
    assert sorted(found) == [(1, i, f"line {i}") for i in range(150)]


def plain_status(pages):
    """By sets of line numbers."""
    out = []
    for run in sorted({p[0] for p in pages}):
        own = [p for p in pages if p[0] == run]
        good = [p for p in own if p[3] is not None and p[1] is not None and p[2] is not None and p[1] >= 0]
        held = {i for p in good for i in range(p[1], p[1] + len(p[3]))}
        at = next(i for i in range(len(held) + 1) if i not in held) if good else None
        if len(good) < len(own):
            status = "malformed"
        elif at >= max(p[2] for p in good):
            status = "complete"
        else:
            status = "stalled" if any(p[1] == at and not p[3] for p in good) else "incomplete"
        out.append((run, len(own), len(held), at, status))
    return out


@pytest.mark.parametrize("block", [7, 1 << 16])
def test_pages_at_random(spark, monkeypatch, block):
    monkeypatch.setattr(logs, "SPAN_BLOCK", block)
    monkeypatch.setattr(logs, "LINE_BLOCK", block)
    rng = random.Random(block)
    pages = []
    for run in range(150):
        total = rng.randint(0, 60)
        for _ in range(rng.randint(1, 12)):
            begin = rng.choice([0, rng.randint(0, 60), 7 * rng.randint(0, 8)])
            end = begin + rng.choice([0, 7, 14, rng.randint(0, 30)])
            pages.append((run, begin, total, text_of(begin, end)))
        if rng.random() < 0.05:
            pages.append((run, *rng.choice([(None, 5, ["x"]), (0, None, ["x"]), (0, 5, None), (-3, 5, ["x"])])))
    pages += [(0, 0, 5, text_of(0, 5))] * 200
    made = spark.createDataFrame(pages, PAGES).repartition(3)
    assert sorted(map(tuple, logs.page_status(made).collect())) == plain_status(pages)
    held = {(p[0], i) for p in pages if None not in p and p[1] >= 0 for i in range(p[1], p[1] + len(p[3]))}
    assert sorted(map(tuple, logs.assemble_pages(made).collect())) == sorted((r, i, f"line {i}") for r, i in held)


@pytest.mark.parametrize("least", [1, 10**6])
def test_number_lines(spark, least):
    """One run holds a third of the lines and is cut into ranges if `least` is low."""
    rng = random.Random(least)
    made = []
    for i in range(3000):
        key = (0, "a") if i % 3 == 0 else rng.choice([(None, "a"), (1, None), (1, "b"), (2, "c"), (0, "b")])
        made.append((*key, rng.choice([None, rng.randint(0, 400)]), i, f"text {i}"))
    made += [(0, "a", 77, 9000, "same") for _ in range(50)]
    schema = "`run id` INT, part STRING, at INT, row INT, line STRING"
    df = spark.createDataFrame(made, schema).repartition(4)
    keys = ["run id", "part"]
    found = [tuple(r) for r in logs.number_lines(df, keys, ["at", "row"], hot_part=0.1, min_hot_rows=least).collect()]
    assert len(found) == len(made)
    first = lambda x: (x is not None, x or 0)
    for key in {r[:2] for r in made}:
        own = sorted((r for r in made if r[:2] == key), key=lambda r: (first(r[2]), r[3]))
        numbered = sorted((r for r in found if r[:2] == key), key=lambda r: r[5])
        assert [r[:5] for r in numbered] == own
        assert [r[5] for r in numbered] == list(range(len(own)))
    pages = logs.paginate(df, keys, ["at", "row"], 7, hot_part=0.1, min_hot_rows=least).collect()
    own = sorted((r for r in made if r[:2] == (0, "a")), key=lambda r: (first(r[2]), r[3]))
    own_pages = sorted((r["from"], r["log"]) for r in pages if (r["run id"], r["part"]) == (0, "a"))
    assert own_pages == [(i, [r[4] for r in own[i : i + 7]]) for i in range(0, len(own), 7)]


def test_lines_of_a_text(spark):
    df = spark.createDataFrame([(1, "a\\nb"), (2, ""), (3, None)], "id INT, t STRING")
    assert rows(logs.unescape_lines(df, "t", ["id"])) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "")]
