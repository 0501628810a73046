"""Strict JSON parsing of model text with native ``from_json``.

``from_json`` alone is lenient: it accepts trailing junk, turns a bare
object into a one-element array and ignores a stray closing brace.  Python's
``json.loads`` rejects all of these.  To get the strict answer without a
Python UDF the text is wrapped as ``{"v": <text>, "_end": 1}``: ``_end``
is only parsed when ``<text>`` was exactly one JSON value, and the corrupt
record column tells a type mismatch inside the value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atelier.functions.text import _col, extract_tag, let, strip

# Element schemas of the plan blocks (DDL).
IMAGE_LAYER = "struct<layer_id:bigint,layer_prompt:string>"
GROUP = "struct<group_id:string,children:array<bigint>,theme:string>"
TEXT_ELEMENT = (
    "struct<layer_id:bigint,type:string,width:double,height:double,opacity:double,"
    "text:string,font:string,font_size:double,text_align:string,angle:double,"
    "capitalize:boolean,line_height:double,letter_spacing:double>"
)
VERDICT = "struct<bad_layers:array<bigint>,reason:string>"

# Statuses, in the order they are decided.
TAG_MISSING = "TAG_MISSING"
NO_JSON = "NO_JSON"
JSON_INVALID = "JSON_INVALID"
SCHEMA_MISMATCH = "SCHEMA_MISMATCH"
OK = "OK"

STRICT_OPTIONS = {
    "mode": "PERMISSIVE",
    "allowSingleQuotes": "false",
    "allowUnquotedFieldNames": "false",
    "allowComments": "false",
    "allowNumericLeadingZeros": "false",
    "allowBackslashEscapingAnyCharacter": "false",
    "allowUnquotedControlChars": "false",
}


def strict_json(text, value_type: str, stripped: bool = True) -> Column:
    """``struct(valid boolean, typed boolean, v <value_type>)``.

    ``valid``: the text is exactly one JSON value, as Python's ``json.loads``
    reads it (``NaN`` included) -- the wrapper parsed up to its end sentinel,
    and the text is one element when put in brackets (text such as
    ``[], "x": 1`` would smuggle in a key).  ``typed``: the value has the
    declared type in every present field.  ``v`` is the parsed value (NULL
    unless valid).  The text, stripped unless told otherwise, and the parse
    are evaluated once per row.
    """
    schema = f"v {value_type}, _end int, _corrupt_record string"

    def on_text(t: Column) -> Column:
        wrapped = F.concat(F.lit('{"v":'), t, F.lit(',"_end":1}'))

        def on_parsed(p: Column) -> Column:
            single = F.size(F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>", STRICT_OPTIONS)) == 1
            sound = F.coalesce((p["_end"] == 1) & single, F.lit(False))

            def on_valid(valid: Column) -> Column:
                typed = valid & p["_corrupt_record"].isNull() & p["v"].isNotNull()
                return F.struct(valid.alias("valid"), typed.alias("typed"), F.when(valid, p["v"]).alias("v"))

            return let(sound, on_valid)

        return let(F.from_json(wrapped, schema, STRICT_OPTIONS), on_parsed)

    return let(strip(_col(text)) if stripped else _col(text), on_text)


def _required_ok(items: Column, required: tuple[str, ...]) -> Column:
    if not required:
        return F.lit(True)
    def all_present(x):
        cond = x[required[0]].isNotNull()
        for f in required[1:]:
            cond = cond & x[f].isNotNull()
        return cond

    return F.coalesce(F.forall(items, all_present), F.lit(False))


def parse_block(text, tag: str, element_type: str = IMAGE_LAYER, required: tuple[str, ...] = ("layer_id", "layer_prompt")) -> Column:
    """Find ``<tag>`` in ``text`` and parse its body as a JSON array.

    Returns ``struct(status string, items array<element_type>)`` where
    status is TAG_MISSING, JSON_INVALID, SCHEMA_MISMATCH or OK; ``items``
    is set only for OK.
    """

    def on_tag(tagged: Column) -> Column:
        def on_parsed(parsed: Column) -> Column:
            items = parsed["v"]
            status = (
                F.when(~tagged["present"], F.lit(TAG_MISSING))
                .when(~parsed["valid"], F.lit(JSON_INVALID))
                .when(~parsed["typed"] | ~_required_ok(items, required), F.lit(SCHEMA_MISMATCH))
                .otherwise(F.lit(OK))
            )
            return F.struct(status.alias("status"), F.when(status == OK, items).alias("items"))

        return let(strict_json(tagged["body"], f"array<{element_type}>"), on_parsed)

    return let(extract_tag(text, tag), on_tag)


def parse_layers(text, tag: str = "image_generator") -> Column:
    """The image-layer list of a plan document."""
    return parse_block(text, tag, IMAGE_LAYER, ("layer_id", "layer_prompt"))


def parse_groups(text, tag: str = "grouping") -> Column:
    return parse_block(text, tag, GROUP, ())


def parse_text_elements(text, tag: str = "generate_text") -> Column:
    return parse_block(text, tag, TEXT_ELEMENT, ())


def greedy_object(text) -> Column:
    """Greedy first ``{`` to last ``}`` (dot matches newline); NULL when none."""
    pat = r"(?s)\{.*\}"
    return let(F.regexp_extract(_col(text), pat, 0), lambda m: F.when(m != "", m))


def extract_verdict(text) -> Column:
    """Quality verdict inside free model text.

    ``struct(status, bad_layers array<bigint>, reason map<string,string>,
    reason_json string)``.  status: NO_JSON (no braces), JSON_INVALID,
    SCHEMA_MISMATCH, OK.  A missing (or null) ``bad_layers`` means no bad
    layers.  Any ``reason`` goes through as ``reason_json`` (its text, or its
    JSON if it isn't text); the map is empty unless it is an object.
    """

    def on_obj(obj: Column) -> Column:
        def on_parsed(parsed: Column) -> Column:
            v = parsed["v"]
            status = (
                F.when(obj.isNull(), F.lit(NO_JSON))
                .when(~parsed["valid"], F.lit(JSON_INVALID))
                .when(~parsed["typed"], F.lit(SCHEMA_MISMATCH))
                .otherwise(F.lit(OK))
            )
            ok = status == OK
            bad = F.when(ok, F.coalesce(v["bad_layers"], F.array().cast("array<bigint>")))
            empty = F.create_map().cast("map<string,string>")
            parts = F.when(v["reason"].startswith("{"), F.from_json(v["reason"], "map<string,string>", STRICT_OPTIONS))
            return F.struct(status.alias("status"), bad.alias("bad_layers"), F.when(ok, F.coalesce(parts, empty)).alias("reason"), F.when(ok, v["reason"]).alias("reason_json"))

        return let(strict_json(obj, VERDICT), on_parsed)

    return let(greedy_object(text), on_obj)


def json_string(c) -> Column:
    """A string as a JSON string literal (quotes and escapes), non-ASCII kept;
    NULL becomes ``null``."""
    js = F.to_json(F.struct(_col(c).alias("s")))
    body = F.regexp_extract(js, r'(?s)^\{"s":(.*)\}$', 1)
    return F.when(_col(c).isNull(), F.lit("null")).otherwise(body)
