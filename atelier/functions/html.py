"""HTML output checks as boolean columns (the contract stated to the model).

- a container element whose ``class`` attribute has the token ``poster``;
- all content inside that container (nothing visible outside it);
- not wrapped in a Markdown code fence;
- nothing but HTML (no prose before the first tag or after the last).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from atelier.constants import POSTER_CLASS
from atelier.functions.text import _col, let, strip


def class_tag(token: str) -> str:
    """Regex (no flags) of an opening tag whose class list has ``token`` as
    a whole token."""
    if not re.match(r"^[A-Za-z0-9_\-]+$", token):
        raise ValueError(f"class token must be a plain name, got {token!r}")
    return rf"""<[a-z][a-z0-9]*\s[^>]*class\s*=\s*["']([^"']*\s)?{token}(\s[^"']*)?["']"""


def class_token_pattern(token: str) -> str:
    return "(?is)" + class_tag(token)


def has_container(html, token: str = POSTER_CLASS) -> Column:
    return F.coalesce(_col(html).rlike(class_token_pattern(token)), F.lit(False))


def in_code_fence(html) -> Column:
    return F.coalesce(strip(html).startswith("```"), F.lit(False))


def only_html(html) -> Column:
    """The stripped text starts with ``<`` and ends with ``>``."""
    t = strip(html)
    return F.coalesce(t.startswith("<") & t.endswith(">"), F.lit(False))


def body_text_outside(html, token: str = POSTER_CLASS) -> Column:
    """Visible text in ``<body>`` that precedes the container's opening tag.

    Scripts, styles and comments are removed first; the remainder between
    ``<body>`` and the container is stripped of tags and whitespace.
    """
    col = _col(html)
    cleaned = F.regexp_replace(col, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", "")
    before = F.regexp_extract(cleaned, r"(?is)<body[^>]*>(.*?)" + class_tag(token), 1)
    text = F.regexp_replace(before, r"(?s)<[^>]*>", "")
    return strip(text)


def html_contract(html, token: str = POSTER_CLASS) -> Column:
    """``struct(has_container, in_fence, only_html, outside_text_chars, ok)``."""
    hc = has_container(html, token)
    fence = in_code_fence(html)
    only = only_html(html)
    outside = F.when(hc, F.length(body_text_outside(html, token))).cast("bigint")
    ok = hc & ~fence & only & F.coalesce(outside == 0, F.lit(False))
    return F.struct(
        hc.alias("has_container"),
        fence.alias("in_fence"),
        only.alias("only_html"),
        outside.alias("outside_chars"),
        ok.alias("ok"),
    )


def render_ready(html, token: str = POSTER_CLASS) -> Column:
    """Renders to an image only if the document has the container."""
    return F.coalesce(_col(html).isNotNull() & has_container(html, token), F.lit(False))


def tag_position(html, token: str) -> Column:
    """1-based code-point position of a literal token, 0 when absent."""
    return F.instr(_col(html), token).cast("bigint")


# Elements without an end tag, and those that show nothing by themselves.
VOID = ("area", "br", "col", "embed", "hr", "img", "input", "source", "track", "wbr")
SILENT = ("", "html", "body", "meta", "link", "base")


def outside_container(html, token: str = POSTER_CLASS) -> Column:
    """``struct(text_chars bigint, elements bigint)``: visible text and
    elements outside the first container.

    Scripts, styles, comments and the head show nothing.  The container ends
    where as many end tags of its name as start tags have come.  An element
    around the container is not outside of it; one that ends before it, or
    starts after it, is.  NULL without a container.
    """
    gone = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<head\b.*?</head>|<title\b.*?</title>|<!doctype[^>]*>"
    pieces = F.regexp_extract_all(F.regexp_replace(_col(html), gone, ""), F.lit(r"(?s)<[^>]*>|[^<]+|<"), F.lit(0))
    tags = F.transform(
        pieces,
        lambda p: F.struct(
            p.alias("p"),
            F.lower(F.regexp_extract(p, r"^</?([A-Za-z][A-Za-z0-9]*)[^>]*>$", 1)).alias("name"),
            p.startswith("</").alias("ends"),
            (p.startswith("<") & p.endswith(">")).alias("tag"),
            p.rlike(class_token_pattern(token)).alias("box"),
        ),
    )
    # depth: -1 before the container, 0 after it, else its open tags of its own name
    start = F.struct(F.lit(-1).alias("depth"), F.lit("").alias("name"), F.lit(0).cast("bigint").alias("text"), F.lit(0).cast("bigint").alias("elements"))

    def state(depth: Column, name: Column, text: Column, elements: Column) -> Column:
        return F.struct(depth.alias("depth"), name.alias("name"), text.alias("text"), elements.alias("elements"))

    def step(a: Column, x: Column) -> Column:
        same = x["name"] == a["name"]
        inside = state(a["depth"] + F.when(~same, 0).when(x["ends"], -1).otherwise(1), a["name"], a["text"], a["elements"])
        shows = F.when(x["name"].isin(*VOID), ~x["ends"]).otherwise(F.when(a["depth"] < 0, x["ends"]).otherwise(~x["ends"])) & ~x["name"].isin(*SILENT)
        beside = state(a["depth"], a["name"], a["text"], a["elements"] + F.when(shows, 1).otherwise(0))
        words = state(a["depth"], a["name"], a["text"] + F.length(strip(x["p"])), a["elements"])
        return (
            F.when(a["depth"] > 0, F.when(x["tag"], inside).otherwise(a))
            .when(~x["tag"], words)
            .when((a["depth"] < 0) & x["box"] & ~x["ends"], state(F.lit(1), x["name"], a["text"], a["elements"]))
            .otherwise(beside)
        )

    end = F.aggregate(tags, start, step)
    return let(end, lambda e: F.when(e["depth"] >= 0, F.struct(e["text"].alias("text_chars"), e["elements"].alias("elements"))))


def poster_contract(html, token: str = POSTER_CLASS) -> Column:
    """The whole contract: HTML only, no code fence, and all content inside
    the container -- text, images and elements, before it and after it, with
    or without ``<body>``.  (``html_contract`` looks at the text in front.)"""

    def judge(o: Column) -> Column:
        clean = F.coalesce((o["text_chars"] == 0) & (o["elements"] == 0), F.lit(False))
        return F.struct(
            has_container(html, token).alias("has_container"), o["text_chars"].alias("outside_chars"), o["elements"].alias("outside_elements"),
            (has_container(html, token) & clean & ~in_code_fence(html) & only_html(html)).alias("ok"),
        )

    return let(outside_container(html, token), judge)
