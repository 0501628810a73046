"""Personal data in text, with DataFrame functions only.

Regular expressions propose spans, checks on their digits (Luhn, mod 97,
ranges, counts) confirm them, and context words nearby move their score.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points before and after a span that count as nearby; how far a word of
#: the kind, or a contrary word, moves the score.
NEARBY, MOVE = 40, 0.3
CONTRARY = "version|isbn|order|invoice|serial|release|build|chapter"
_CARD_WORDS = "card|visa|credit|karte|carte|tarjeta|pay"
_LOCAL = "A-Za-z0-9._%+-"


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """From the right, every second digit counts double, less 9 if over 9."""
    value = lambda c: F.ascii(c) - 48
    each = F.transform(F.split(F.reverse(digits(m)), ""), lambda c, i: F.when(i % 2 == 0, value(c)).when(value(c) > 4, 2 * value(c) - 9).otherwise(2 * value(c)))
    return F.aggregate(each, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(m: Column) -> Column:
    """An account number: its first four characters go to the end, letters
    count from 10, and the remainder must be 1."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    step = lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes (``has`` is a cheap condition for that) and
    ``check`` confirms; ``near`` are context words.  A span of an added kind
    must reach the score ``least``."""

    name: str
    pattern: str
    check: Callable[[Column], Column]
    prior: float
    near: str
    has: str
    base: bool = True
    least: float = 0.0


# A base pattern starts where its run of characters does, or right where the
# span before ended: so a run without a match is tried once only, and
# possessive quantifiers never go back over it.
KINDS = (
    Kind("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), 0.9, "mail|contact|write|kontakt|correo|courriel", "@"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda m: m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:[.]|$)){4}$"), 0.7, r"\bip\b|addr|host|server|login|client", "."),
    Kind("card", r"[0-9](?:[ -]?+[0-9]){15,}+", lambda m: F.length(digits(m)).between(16, 19) & luhn(m), 0.9, _CARD_WORDS, ""),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda m: F.length(digits(m)).between(8, 15), 0.8, r"\btel|phone|call|fax|mobil|telefon|llam", "+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", lambda m: F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34) & mod97(m), 0.9, "iban|bank|account|konto|compte|cuenta", "", False, 0.5),
    Kind("secret", r"(?<![A-Za-z0-9])(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)[\"']?[ ]?[:=][ ]?[\"']?[A-Za-z0-9+/_=-]{16,}+", lambda m: F.length(digits(m)) >= 4, 0.8, "auth|login|bearer|credential", "", False, 0.5),
    Kind("card13", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){12,14}+(?![ -]?[0-9])", luhn, 0.3, _CARD_WORDS, "", False, 0.5),
)
BASE = tuple(k for k in KINDS if k.base)

_SPANS = "array<struct<start:bigint,end:bigint,score:double>>"


#: Matches that are placed in one go.
CHUNK = 128


def _confirmed(kind: Kind, found: str, gaps: str) -> Column:
    """Array of (start, end, score) in code points, from the matches and the
    text between them."""
    parts = F.transform(
        F.arrays_zip(F.col(found), F.col(gaps), F.slice(gaps, F.lit(2), F.size(found)).alias("after")),
        lambda x: F.struct(
            x[found].alias("m"), F.char_length(x[gaps]).cast("long").alias("gap"), F.char_length(x[found]).cast("long").alias("len"),
            F.lower(F.concat_ws(" ", F.right(x[gaps], F.lit(NEARBY)), F.left(x.getField("after"), F.lit(NEARBY)))).alias("near"),
        ),
    )

    def place(a: Column, x: Column) -> Column:
        start, end = a["at"] + x["gap"], a["at"] + x["gap"] + x["len"]
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m"), x["near"].alias("near"))
        return F.when(x["m"].isNull(), a).otherwise(F.struct(end.alias("at"), F.concat(a["out"], F.array(span)).alias("out")))

    # running sums in two levels: a chunk's matches grow one short array, and chunks are joined once
    none = F.array().cast("array<struct<start:bigint,end:bigint,m:string,near:string>>")

    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        """``use`` of a value that is computed once."""
        return F.element_at(F.transform(F.array(value), use), 1)

    def chunked(p: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / CHUNK).cast("int")), lambda c: F.slice(p, c * CHUNK + 1, F.lit(CHUNK)))

    def located(c: Column) -> Column:
        """The matches of all chunks with their places in the text."""
        sizes = F.transform(c, lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, p: a + p["gap"] + F.coalesce(p["len"], F.lit(0))))
        begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
        bases = F.aggregate(sizes, begin, lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        return F.flatten(F.zip_with(c, bases, lambda x, b: F.aggregate(x, F.struct(b.alias("at"), none.alias("out")), place, lambda a: a["out"])))

    placed = once(parts, lambda p: once(chunked(p), located))

    def rated(x: Column) -> Column:
        move = F.when(x["near"].rlike(kind.near), MOVE).otherwise(0.0) - F.when(x["near"].rlike(CONTRARY), MOVE).otherwise(0.0)
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(kind.prior) + move)), 3).alias("score"))

    ok = F.transform(F.filter(placed, lambda x: kind.check(x["m"])), rated)
    if not kind.base:
        ok = F.filter(ok, lambda x: x["score"] >= kind.least)
    return F.when(F.size(found) > 0, ok).otherwise(F.array()).cast(_SPANS)


def find_personal_data(docs: DataFrame, text: str = "text", out: str = "found") -> DataFrame:
    """``docs`` with a struct column ``out``: per kind an array of spans
    (start, end, score), in code points, end exclusive, in order.

    Base kinds keep all spans that pass their check, whatever the score; the
    added kinds (account numbers by mod 97, cards of 13 to 15 digits by Luhn,
    values of 16 or more characters with four digits that are assigned to a
    token, key or password) keep those of 0.5 or more.  Every row stays; a column named ``out`` is
    replaced.  Null and empty texts have no spans.  No shuffle, no Python.
    """
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    t = F.coalesce(F.col(f"r.`{text}`").cast("string"), F.lit(""))
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"))
    for k in KINDS:
        some = F.contains(t, F.lit(k.has)) if k.has else t.rlike("[0-9]")
        found = found.withColumn(f"m_{k.name}", F.when(some, F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    for k in KINDS:
        found = found.withColumn(f"g_{k.name}", F.when(F.size(f"m_{k.name}") > 0, F.split(t, k.pattern, -1)).otherwise(F.array().cast("array<string>")))
    spans = F.struct(*[_confirmed(k, f"m_{k.name}", f"g_{k.name}").alias(k.name) for k in KINDS])
    return found.select(*[F.col(f"r.`{c}`").alias(c) for c in keep], spans.alias(out))


def named_spans(out: str, kinds: tuple[Kind, ...], score: bool = False) -> Column:
    """kind:start:end (and :score) of all spans, by kind as listed, then start."""
    def one(k: Kind) -> Column:
        return F.transform(F.col(f"{out}.{k.name}"), lambda x: F.concat_ws(":", F.lit(k.name), x["start"], x["end"], *([x["score"]] if score else [])))

    return F.concat_ws(",", *[one(k) for k in kinds])
