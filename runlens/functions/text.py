"""String and HTML column functions."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The five basic HTML entities, `&amp;` last so that `&amp;lt;`
# becomes `&lt;` and no further.
BASIC_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def quote_name(name: str) -> str:
    """A column name as a quoted identifier; already quoted names pass through."""
    if len(name) > 1 and name.startswith("`") and name.endswith("`"):
        return name
    return "`" + name.replace("`", "``") + "`"


def path_safe(col: Column | str) -> Column:
    """Run ids hold colons, which paths must not: `:` becomes `-`."""
    return F.replace(as_column(col), F.lit(":"), F.lit("-"))


def unescape_newlines(col: Column | str) -> Column:
    """The two characters backslash and n become a line break."""
    return F.replace(as_column(col), F.lit("\\n"), F.lit("\n"))


def decode_basic_entities(text: Column) -> Column:
    """Decode the five basic HTML entities, inside the JVM."""
    for entity, char in BASIC_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def decode_all_entities(text: Column) -> Column:
    """Decode named and numeric HTML entities alike, for which Spark has no function."""

    @F.pandas_udf("string")
    def unescape(values: pd.Series) -> pd.Series:
        return values.map(html.unescape, na_action="ignore")

    return unescape(text)


# Elements whose content is no markup, up to their own closing tag.
RAW_ELEMENTS = ("script", "style")

# Quoted attribute values count as units: they may hold `>` and `/`.
_ATTRIBUTES = r"""(?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+"""
_RAW_OPENING = rf"<(?:{'|'.join(RAW_ELEMENTS)})(?=[\s>/]){_ATTRIBUTES}(?<!/)>"
_TOKEN = "|".join(
    (
        r"<!--.*?(?:-->|\z)",
        r"<!\[CDATA\[.*?(?:\]\]>|\z)",
        r"<(?:[!?]|/(?![a-z]))[^>]*+(?:>|\z)",
        # With all that it holds, up to the closing tag, which is a token of its own.
        *(rf"<{x}(?=[\s>/]){_ATTRIBUTES}(?<!/)>.*?(?=</{x}(?:[\s>/]|\z)|\z)" for x in RAW_ELEMENTS),
        r"</[a-z][^>]*+(?:>|\z)",
        rf"<[a-z]{_ATTRIBUTES}>",
        r"[^<]++",
        r"<",
    )
)


def html_tokens(col: Column | str) -> Column:
    """An HTML document cut into tags, comments and the like, raw elements with their text, and text runs."""
    return F.regexp_extract_all(as_column(col), F.lit(f"(?is){_TOKEN}"), F.lit(0))


def tag_text(col: Column | str, tag: str = "pre", all_entities: bool = False) -> Column:
    """Text of the last `tag` element of an HTML document, NULL without one.

    The text of an element runs to the first closing or self-closing tag of any
    name, and of several text runs in it (parted by opening tags or comments) the
    last one counts. Scripts and styles are one text run each, in which nothing opens or
    closes an element and no entity is decoded; comments, CDATA sections and declarations
    hold no text. The five basic entities are decoded; `all_entities` decodes
    every one, at the price of passing the text found through Python.

    One scan over the document's tokens, inside the JVM, with the element's state and the
    text found last.
    """
    name = re.escape(tag)

    def state(inside: Column, text: Column, raw: Column) -> Column:
        return F.struct(inside.alias("inside"), text.alias("text"), raw.alias("raw"))

    def step(now: Column, token: Column) -> Column:
        inside, text, raw = now["inside"], now["text"], now["raw"]
        is_text = ~token.startswith("<") | (token == "<")
        opens = token.rlike(rf"(?i)\A<{name}[\s>/]")
        held = F.regexp_replace(token, rf"(?is)\A{_RAW_OPENING}", "")
        found = (inside | opens) & (held != "")
        ends = token.endswith("/>") | token.rlike(r"(?i)\A</[a-z]")
        return (
            F.when(is_text, state(inside, F.when(inside, token).otherwise(text), ~inside & raw))
            .when(token.startswith("<!") | token.startswith("<?"), now)
            .when(
                token.rlike(rf"(?is)\A{_RAW_OPENING}"),
                state(inside | opens, F.when(found, held).otherwise(text), found | raw),
            )
            .when(ends, state(F.lit(False), text, raw))
            .when(opens, state(F.lit(True), text, raw))
            .otherwise(now)
        )

    start = state(F.lit(False), F.lit(None).cast("string"), F.lit(False))
    last = F.aggregate(html_tokens(col), start, step)
    decoded = decode_all_entities(last["text"]) if all_entities else decode_basic_entities(last["text"])
    return F.when(last["raw"], last["text"]).otherwise(decoded)
