"""URL filtering: rules first, gradient-boosted trees for the rest.

The trees read lexical features of the URL only: lengths, depth, digit ratio,
entropy, parameter counts, and how often URLs of the host's suffix were
blocked among labelled ones.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.llm import common as C

#: Labelled URLs that grow the trees, about and by their hash: never more than
#: half of them.  All others give the suffix statistics.
SAMPLE_ROWS = 10_000
TREES, DEPTH, STEP, SEED = 20, 4, 0.2, 7
#: Labelled URLs that the overall share counts as, in a suffix's share.
PRIOR = 5.0
BLOCK_AT = 0.5

#: Host and path of each rule, and its verdict.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, with A-Z in
    lower case, and what follows that up to ``?`` or ``#``; both empty for
    null and for a URL without ``://``."""
    at = F.locate("://", url)
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule whose host is the URL's or a parent of it and whose
    path starts the URL's; null if none fits.  ``rules`` is a short list."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, start = rule.partition("/")
        fits = (host == name) | F.endswith(host, F.lit("." + name))
        found = F.when(fits & F.startswith(path, F.lit(slash + start)), F.lit(rule)).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Bits per character."""
    chars = F.split(text, "")
    n = F.length(text).cast("double")
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
    bits = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    return F.when(F.length(text) > 0, bits).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    size = F.length(text).cast("double")
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    return {
        "length": size,
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "labels": _count(host, "[.]") + 1,
        "depth": _count(path, "/"),
        "digit_ratio": _count(text, "[0-9]") / F.greatest(size, F.lit(1.0)),
        "hyphens": _count(text, "[-_]"),
        "host_hyphens": _count(host, "-"),
        "parameters": F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(0.0),
        "query_length": F.length(query).cast("double"),
        "fragment": F.contains(text, F.lit("#")).cast("double"),
        "secure": F.startswith(text, F.lit("https:")).cast("double"),
        "entropy": entropy(text),
        "host_entropy": entropy(host),
    }


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, url: str = "url", rules: dict[str, str] = RULES, label: str = "label", out: str = "filter") -> DataFrame:
    """``pages`` with a struct column ``out``: ``host``, ``path``, ``rule``
    (null if none fits), ``score`` (of being blocked) and ``verdict``.

    ``labelled`` has the columns ``url`` and ``label`` (1 block, 0 allow; rows
    with a null in either don't count); without it the pages that a rule
    decides are the labelled URLs.  A rule's verdict stands; else the trees'
    does, and without labels of both kinds all is allowed.  Every row stays; a
    column named ``out`` is replaced; null and broken URLs have an empty host
    and path and are judged by the trees like any other; equal URLs have equal
    verdicts; an empty table gives none.
    """
    model, featured = url_model(pages, labelled, url, rules, label)
    host, path = host_and_path(F.col("url"))
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row")
    given = pages.select(row, F.col(f"`{url}`").cast("string").alias("url")).withColumn("host", host).withColumn("path", path)
    if model is None:
        judged = given.withColumn("score", F.lit(0.0))
    else:
        judged = model.transform(featured(given, ["row"])).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(_verdicts(rules), F.when(F.col("score") >= BLOCK_AT, "block").otherwise("allow"))
    keep = [c for c in pages.columns if c.lower() != out.lower()]
    value = F.struct("host", "path", "rule", "score", verdict.alias("verdict"))
    return judged.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], value.alias(out))


def _verdicts(rules: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for r in rules.items() for x in r])[F.col("rule")] if rules else F.lit(None).cast("string")


def url_model(pages: DataFrame, labelled: DataFrame | None, url: str, rules: dict[str, str], label: str):
    """The trees (None without labels of both kinds) and the function that
    gives them a table's features: ``(url, host, path, ...) -> features``."""
    host, path = host_and_path(F.col("url"))
    seen = (pages if labelled is None else labelled).select(F.col(f"`{url}`").cast("string").alias("url"), *([] if labelled is None else [F.col(f"`{label}`").cast("double").alias("label")]))
    seen = seen.withColumn("host", host).withColumn("path", path)
    if labelled is None:
        verdict = _verdicts(rules)
        seen = seen.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("label", F.when(verdict == "block", 1.0).when(verdict == "allow", 0.0))
    seen = C.written(seen.filter("url is not null and label in (0, 1)").select("url", "host", "path", "label", F.xxhash64("url").alias("h")), "labelled")
    n, total = seen.agg(F.count("*"), F.avg("label")).first()
    chosen = F.pmod("h", F.lit(1 << 20)) < int((1 << 20) * min(0.5, SAMPLE_ROWS / max(n, 1)))
    suffix = lambda h: F.substring_index(h, ".", -1)
    share = (F.sum("label") + PRIOR * (total or 0.0)) / (F.count("*") + PRIOR)
    stats = C.written(seen.filter(~chosen).groupBy(suffix(F.col("host")).alias("suffix")).agg(share.alias("suffix_share"), F.log1p(F.count("*")).alias("suffix_seen")), "suffixes")
    n_suffixes = stats.count()

    def featured(df: DataFrame, keep: list[str]) -> DataFrame:
        columns = lexical(F.col("url"), F.col("host"), F.col("path"))
        df = df.select(*keep, "url", "host", "path", *[c.alias(f"f_{k}") for k, c in columns.items()], suffix(F.col("host")).alias("suffix"))
        df = C.join_small(df, stats, "suffix", n_suffixes, ["url"], "left")
        df = df.withColumn("f_suffix_share", F.coalesce("suffix_share", F.lit(total or 0.0))).withColumn("f_suffix_seen", F.coalesce("suffix_seen", F.lit(0.0)))
        names = [f"f_{k}" for k in columns] + ["f_suffix_share", "f_suffix_seen"]
        return VectorAssembler(inputCols=names, outputCol="features").transform(df).select(*keep, "url", "host", "path", "features")

    learn = featured(seen.filter(chosen).dropDuplicates(["url", "label"]), ["label"])
    model = None
    if total is not None and learn.select("label").distinct().count() == 2:
        model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED).fit(learn)
    return model, featured
