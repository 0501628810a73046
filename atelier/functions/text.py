"""String, tag, path and binary column expressions.

All functions take and return ``Column``s built from native Spark
expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from atelier.constants import (
    AFTER_IMAGE_REFINE_HTML,
    INIT_HTML,
    LAYER_URL_FORMAT,
    LAYOUT_PROMPT_FILE,
    PY_WHITESPACE_CLASS,
    REFERENCE_IMAGE_FORMAT,
    REFINED_HTML_FORMAT,
    REPAIR_SUMMARY_FILE,
    TEMP_LAYER_URL_FORMAT,
)

_TAG_NAME = re.compile(r"^[A-Za-z0-9_:\-]+$")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once per row and hand it to ``fn`` (Column -> Column).

    Python builds expression trees, so a sub-expression referenced several
    times is repeated in the plan and evaluated once per reference.  Binding
    it as a lambda variable evaluates it once.
    """
    return F.transform(F.array(value), fn)[0]


def _check_tag(tag: str) -> str:
    if not _TAG_NAME.match(tag):
        raise ValueError(f"tag names are plain identifiers, got {tag!r}")
    return tag


def strip(c) -> Column:
    """Python ``str.strip()``: removes every Unicode whitespace code point at
    both ends (Spark ``trim`` removes only spaces)."""
    ws = PY_WHITESPACE_CLASS
    return F.regexp_replace(_col(c), f"^{ws}+|{ws}+$", "")


def tag_pattern(tag: str) -> str:
    """First ``<tag>...</tag>``, non-greedy, dot matching newlines."""
    t = _check_tag(tag)
    return f"(?s)<{t}>(.*?)</{t}>"


def extract_tag(c, tag: str) -> Column:
    """``struct(present boolean, body string)``.

    ``present`` tells an absent tag from an empty one; ``body`` is the
    stripped text of the first occurrence, NULL when absent.
    """
    pat = tag_pattern(tag)
    col = _col(c)
    return let(
        col.rlike(pat),
        lambda present: F.struct(present.alias("present"), F.when(present, strip(F.regexp_extract(col, pat, 1))).alias("body")),
    )


def tag_count(c, tag: str, closing: bool = False) -> Column:
    t = _check_tag(tag)
    token = f"</{t}>" if closing else f"<{t}>"
    return F.regexp_count(_col(c), F.lit(token)).cast("bigint")


def bool_verdict(c) -> Column:
    """``strip().lower() == "true"``; NULL input is false."""
    return F.coalesce(F.lower(strip(c)) == F.lit("true"), F.lit(False))


def layer_url(layer_id, temp: bool = False) -> Column:
    fmt = TEMP_LAYER_URL_FORMAT if temp else LAYER_URL_FORMAT
    prefix, suffix = fmt.split("{}")
    return F.concat(F.lit(prefix), _col(layer_id).cast("string"), F.lit(suffix))


def similarity_format(c, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", _col(c).cast("double"))


# splitext: the last "." of the basename that has a non-dot character before
# it inside the basename.  Written without look-behind so the same pattern
# runs on Java regex and RE2.
_EXT_PATTERN = r"[^/.]\.*(\.[^./]*)$"


def path_extension(c) -> Column:
    """``os.path.splitext(p)[1]``."""
    return F.regexp_extract(_col(c), _EXT_PATTERN, 1)


def path_root(c) -> Column:
    """``os.path.splitext(p)[0]``."""
    return F.regexp_replace(_col(c), r"([^/.]\.*)\.[^./]*$", "$1")


def artifact_path(c, suffix: str = ".png") -> Column:
    """Replace the last extension with ``suffix`` (``splitext(p)[0] + suffix``)."""
    return F.concat(path_root(c), F.lit(suffix))


def example_paths(id_col) -> Column:
    """``struct(layout_prompt, init_html, repaired_html, repair_summary)``: the
    files of an example, in the folder that its id names."""
    in_folder = lambda name: F.concat(_col(id_col).cast("string"), F.lit(f"/{name}"))
    return F.struct(
        in_folder(LAYOUT_PROMPT_FILE).alias("layout_prompt"), in_folder(INIT_HTML).alias("init_html"),
        in_folder(AFTER_IMAGE_REFINE_HTML).alias("repaired_html"), in_folder(REPAIR_SUMMARY_FILE).alias("repair_summary"),
    )


def round_paths(id_col, round_) -> Column:
    """``struct(reference, html)``: the files of a refinement round (from 1)."""
    def named(pattern: str) -> Column:
        before, after = pattern.split("{}")
        return F.concat(_col(id_col).cast("string"), F.lit(f"/{before}"), _col(round_).cast("string"), F.lit(after))

    return F.struct(named(REFERENCE_IMAGE_FORMAT).alias("reference"), named(REFINED_HTML_FORMAT).alias("html"))


def data_url(content, mime: str = "image/png") -> Column:
    """``data:<mime>;base64,<payload>`` without the CRLF breaks that Spark's
    ``base64`` inserts every 76 characters."""
    payload = F.regexp_replace(F.base64(_col(content)), "[\r\n]", "")
    return F.concat(F.lit(f"data:{mime};base64,"), payload)


def unbase64_payload(c) -> Column:
    """Decode a base64 payload, with or without a ``data:`` prefix."""
    col = _col(c)
    body = F.regexp_replace(col, r"^data:[^,]*,", "")
    return F.unbase64(body)


def elapsed_minutes(start, end, digits: int | None = 4) -> Column:
    """Minutes between two timestamps (NTZ or LTZ), as double."""
    diff = F.timestamp_diff("MICROSECOND", _col(start), _col(end)).cast("double") / F.lit(60_000_000.0)
    return F.round(diff, digits) if digits is not None else diff
