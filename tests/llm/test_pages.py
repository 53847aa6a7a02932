from __future__ import annotations

import pytest

from runlens.llm import html
from tests.llm.helpers import ODD_ROWS

PRIOR = html.Weights({})


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("<p>", ""),
        ("just text", "just text"),
        ("<p>a &lt;b&gt; &amp;amp; &eacute;&#233; &copy</p>", "a <b> &amp; éé ©"),
        ("<p>one\n  two\t<b>three</b>four<br>five</p><p>six", "one two threefour five\n\nsix"),
        ("<nav><a href=x>Menu</a></nav><p>Body text here.</p><footer>Foot</footer>", "Body text here."),
        ("<header>Site name</header><h1>Title</h1><p>Body of it</p><aside>more</aside>", "Title\n\nBody of it"),
        ("<p>Words of it<script>var x = '</p>';</script> go on</p>", "Words of it go on"),
        ("<style>p{}</style><!-- <p>no</p> --><p>3 < 4 and so on</p>", "3 < 4 and so on"),
        ('<div class="cookie-notice">We use cookies</div><p title="a>b">Real text stands here</p>', "Real text stands here"),
        ("<p>Text one of it<!-- never closed", "Text one of it"),
        ("<form><label>Name</label><input></form><p>Text two of it</p>", "Text two of it"),
    ],
)
def test_pages_without_labels(page, text):
    assert html.main_text(page, PRIOR) == text


def test_asides_inside_an_article_are_left_out():
    inside = '<p>First part of it.</p><div class="ad">Buy this and that and more of all now</div><p>Last.</p>'
    page = f"<body><div>Home</div><article><h1>T</h1>{inside}<section id='comments'><p>nice</p></section></article>"
    counts = html.Counter()
    for _ in range(20):
        counts.update(html.observed(f"<nav><a>x y</a></nav><div>Home of all</div><article><h1>T</h1>{inside}</article>"))
    assert html.main_text(page, html.Weights(counts)) == "T\n\nFirst part of it.\n\nLast."


def page(i):
    menu = "".join(f'<li><a href="/{k}">go{k}</a></li>' for k in range(i % 5 + 1))
    body = "".join(f"<p>Paragraph {k} of page {i} &amp; more.</p>" for k in range(i % 4 + 1))
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title></head><body><nav><ul>{menu}</ul></nav>"
        f'<div class="ad">Buy {i}</div><article><h1>Page {i}</h1>{body}</article><footer>&copy; all</footer></body></html>'
    )


def test_extract(spark):
    rows = [(i, f"http://x/{i}", page(i), 1) for i in range(40)]
    rows += [(i, None, text, 2) for i, text in ODD_ROWS] + [(7, "http://x/7", page(7), 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = html.extract(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.url:
            i = r.page_id
            expected = [f"Page {i}"] + [f"Paragraph {k} of page {i} & more." for k in range(i % 4 + 1)]
            assert r.text == "\n\n".join(expected)
        assert r.n_chars == len(r.text)
    assert {r.text for r in found if r.page_id in (9001, 9002, 9003)} == {""}
    assert html.extract(pages.limit(0)).count() == 0


def test_very_long_page():
    text = "word " * 200_000
    assert html.main_text(f"<nav>menu</nav><p>{text}</p>", PRIOR) == text.strip()


@pytest.mark.parametrize("name", ["site has-sidebar", "layout-sidebar-right", "no-sidebar", "widget", "sidebar"])
def test_names_of_wrappers_keep_the_article(name):
    body = "<p>Words of the article stand here and go on.</p><h2 id='related-work'>Related work</h2><p>More of them.</p>"
    text = "Words of the article stand here and go on.\n\nRelated work\n\nMore of them."
    aside = "<div class='sidebar'>Buy this</div><section id='comments'><article class='comment'>nice</article></section>"
    pages = [
        f"<body><div class='{name}'><article class='post comments-open'>{body}</article></div>{aside}</body>",
        f"<body><div class='{name}'>{body}</div></body>",
        f"<body><main><section id='search-methods'>{body}</section></main>{aside}</body>",
    ]
    for page in pages:
        assert html.main_text(page, html.Weights({})) == text
