"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. Every word and every tag has a weight, words
of article text above zero and tags below, and one linear scan finds the contiguous
stretch with the greatest sum. Weights are log odds from labelled pages: those whose
author has marked the article (`article` or `main`); what is inside counts as content
and what is outside, or in a menu, advert or the like inside, does not.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.shared import pick, text_batches

# Weights come from this many labelled pages at most, those of the smallest id hashes.
LABELLED_PAGES = 2_000

# What a page is cut into; elements whose content is never text go as a whole.
_SILENT = "script|style|noscript|template|svg|math|iframe|object|canvas|select|textarea|button|title"
_PARTS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<silent>{_SILENT})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<!/)>.*?(?:</(?P=silent)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-z][^<>]*\Z"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)

# Elements that do not end a block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# Elements without content.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that are no article text wherever they stand, and names, ids and roles of others.
_ASIDE = frozenset("nav header footer aside form menu dialog head".split())
_ASIDE_WORD = (
    r"(?:ads?|advert\w*|banner|breadcrumbs?|byline-?links|comments?|comment-?list|cookies?|"
    r"consent|disclaimer|footer|header|masthead|menu|nav|navbar|navigation|newsletter|notices?|alert|"
    r"pager|pagination|popup|promo\w*|related|replies|respond|share|sharing|sidebar|side-?bar|social|"
    r"sponsor\w*|subscribe|widgets?|disqus\w*|contentinfo|complementary|search|toolbar|skip-?link)"
)
# What may stand beside such a word in a name of the same meaning.
_BESIDE = (
    r"(?:site|page|global|main|primary|secondary|top|bottom|left|right|inner|outer|box|block|container|wrapper|wrap|"
    r"area|bar|list|links?|icons?|buttons?|form|section|posts?|articles?|items?|slot|unit|\d+)"
)
_ASIDE_NAME = re.compile(
    rf"(?:^|\s)(?:{_BESIDE}[_-]+)*{_ASIDE_WORD}(?:[_-]+(?:{_ASIDE_WORD}|{_BESIDE}))*(?:$|\s)", re.IGNORECASE
)
_HEADING = re.compile(r"h[1-6]\Z")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
# What an author marks an article with.
_MARKED = frozenset(("article", "main"))

# Counts that a feature starts with, as (inside, outside): words are content and tags
# are not, unless labelled pages say otherwise.
_START = {("word", False): (4, 1), ("word", True): (1, 8), ("tag", False): (1, 1), ("tag", True): (1, 4)}
_MOST = 4.0
_TAG_MOST = -0.02
# What one run of words takes away at most; in a marked article what stands aside takes
# nothing, as it is left out in any case and the article goes on behind it.
_LEAST = -8.0


class Step:
    """A tag, or a run of words; `cut` says that a block ends here."""

    __slots__ = ("feature", "text", "words", "cut", "aside", "marked")

    def __init__(self, feature, text, words, cut, aside, marked):
        self.feature, self.text, self.words = feature, text, words
        self.cut, self.aside, self.marked = cut, aside, marked


def _is_aside(name: str, rest: str) -> bool:
    if name in _ASIDE:
        return True
    if not rest or "=" not in rest and "hidden" not in rest:
        return False
    return _HIDDEN.search(rest) is not None


def _is_named_aside(name: str, rest: str) -> bool:
    """Whether a whole class, id or role says so; those of headings are made from titles."""
    if not rest or "=" not in rest or _HEADING.match(name):
        return False
    return any(_ASIDE_NAME.search(a or b or c) for a, b, c in _NAMES.findall(rest))


def steps(page: str) -> list[Step]:
    """The page as tags and runs of words, each with what surrounds it.

    A name of an element that is or holds the article, or most of the words of a page
    without one, doesn't make it stand aside.
    """
    spans: list[_Span] = []
    found = list(_steps(page, spans, frozenset()))
    if not any(x.named for x in spans):
        return found
    words = [0]
    for step in found:
        words.append(words[-1] + step.words)
    size = lambda x: words[x.end] - words[x.begin]
    marked = [x for x in spans if x.name in _MARKED]
    # Of several articles, as in lists of comments, the one with the most words.
    most = max((x for x in marked if x.name == "article"), key=size, default=None)
    wanted = [x for x in marked if x.name == "main" or x is most]
    spared = frozenset(
        x.at
        for x in spans
        if x.named
        and (any(x.begin <= y.begin and y.end <= x.end for y in wanted) if wanted else 2 * size(x) > words[-1])
    )
    return list(_steps(page, [], spared)) if spared else found


class _Span:
    """An article, or an element whose name says that it stands aside: its place and its steps."""

    __slots__ = ("at", "name", "named", "begin", "end")

    def __init__(self, at, name, named, begin):
        self.at, self.name, self.named, self.begin, self.end = at, name, named, begin, None


def _steps(page: str, spans: list[_Span], spared: frozenset[int]) -> Iterator[Step]:
    """The same, without regard to the names of the elements that begin at the `spared` places."""
    # Name, aside, marked, each with what is around it; the element's span if it has one.
    open_: list[tuple[str, bool, bool, _Span | None]] = []
    links = n = 0

    def close(at):
        for x in open_[at:]:
            if x[3] is not None:
                x[3].end = n
        del open_[at:]

    for part in _PARTS.finditer(page):
        name = part["name"]
        if name:
            name, closes = name.lower(), bool(part["close"])
            if name == "a":
                links = 0 if closes else 1
            if name in ("body", "html"):
                continue  # their end tags are often misplaced
            if name == "p" and not closes or closes and name not in _INLINE:
                while open_ and open_[-1][0] == "p" and name != "p":
                    close(-1)
            around = open_[-1] if open_ else ("", False, False, None)
            if closes:
                at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
                if at is not None:
                    around = open_[at]
                    close(at)
            elif name not in _VOID:
                named = part.start() not in spared and _is_named_aside(name, part["rest"])
                own = named or _is_aside(name, part["rest"])
                aside = around[1] or own
                if name not in _INLINE or aside and not around[1]:
                    if name == "p" and around[0] == "p":
                        close(-1)
                        outer = open_[-1] if open_ else ("", False, False, None)
                        aside = outer[1] or own
                    span = _Span(part.start(), name, named, n) if named or name in _MARKED else None
                    if span is not None:
                        spans.append(span)
                    around = (name, aside, around[2] or name in _MARKED, span)
                    open_.append(around)
            cut = name not in _INLINE
            text = " " if name == "br" else ""
            n += 1
            yield Step(("tag", around[1], name), text, 0, cut, around[1], around[2])
        elif part["text"] is not None:
            text = html.unescape(part["text"])
            around = open_[-1] if open_ else ("", False, False, None)
            kind = "link" if links else around[0]
            n += 1
            yield Step(("word", around[1], kind), text, len(text.split()), False, around[1], around[2])
    close(0)

def observed(page: str) -> Counter:
    """Counts of (kind, aside, name, content) on a labelled page; empty for other pages."""
    counts: Counter = Counter()
    marked = False
    for step in steps(page):
        marked |= step.marked
        if step.feature[0] == "tag" and step.feature[2] in _MARKED:
            continue  # the label itself
        counts[(*step.feature, step.marked and not step.aside)] += step.words or step.feature[0] == "tag"
    return counts if marked else Counter()


class Weights:
    """Log odds of content by feature, with counts to start from for rare features."""

    def __init__(self, counts: dict[tuple[str, bool, str, bool], int]):
        self.counts = counts
        self.known: dict[tuple[str, bool, str], float] = {}

    def __call__(self, feature: tuple[str, bool, str]) -> float:
        found = self.known.get(feature)
        if found is None:
            inside, outside = _START[feature[:2]]
            inside += self.counts.get((*feature, True), 0)
            outside += self.counts.get((*feature, False), 0)
            found = max(-_MOST, min(_MOST, math.log(inside / outside)))
            if feature[0] == "tag":
                found = min(found, _TAG_MOST)
            self.known[feature] = found
        return found


def main_text(page: str, weight: Weights) -> str:
    """The blocks of the best stretch, without what stands aside in it."""
    found = steps(page)
    best, best_from, best_to = 0.0, 0, 0
    total, begin = 0.0, 0
    for i, step in enumerate(found):
        if not (step.aside and step.marked):
            total += max(weight(step.feature) * (step.words or step.feature[0] == "tag"), _LEAST)
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, best_from, best_to = total, begin, i + 1
    blocks, block = [], []
    for step in found[best_from:best_to]:
        if step.cut:
            blocks.append(block)
            block = []
        elif not step.aside:
            block.append(step.text)
    blocks.append(block)
    joined = (" ".join("".join(x).split()) for x in blocks)
    return "\n\n".join(x for x in joined if x)


def learn(pages: DataFrame, most: int = LABELLED_PAGES) -> Weights:
    """Weights from up to `most` labelled pages; few numbers come back, whatever the input.

    The pages are those with the smallest hashes of their id among pages that hold an
    `article` or `main` tag; element names outside HTML's own are rare enough to count
    each, and only the thousand most frequent features are kept.
    """
    marked = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    chosen = marked.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(most).distinct()

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                counts.update(observed(page))
        rows = [(*k, n) for k, n in counts.items() if n]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [pa.string(), pa.bool_(), pa.string(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["kind", "aside", "name", "content", "n"],
        )

    seen = marked.join(F.broadcast(chosen), "page_id", "left_semi").select("html")
    counted = seen.mapInArrow(run, "kind string, aside boolean, name string, content boolean, n long")
    keys = ["kind", "aside", "name", "content"]
    top = counted.groupBy(*keys).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), *keys).limit(1000)
    return Weights({(r["kind"], r["aside"], r["name"], r["content"]): r["n"] for r in top.collect()})


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    One row per input row. NULL or empty html, and pages without words of their own,
    give the empty text; NULL ids and urls are kept; repeated rows stay; an empty table
    gives an empty one; other columns are ignored. Broken markup is read as far as it
    goes, and whole: no page is cut.
    """
    text_batches(pages.sparkSession)
    pages = pick(pages, page_id="long", url="string", html="string")
    weight = weights or learn(pages)

    def run(batches):
        for batch in batches:
            texts = [main_text(x, weight) if x else "" for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
