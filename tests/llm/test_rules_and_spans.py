"""Quality rules, personal data, URL filter: brute force and edge rows."""

import collections
import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from atelier.llm import registry
from atelier.llm.personal_data import BASE, KINDS, find_personal_data, named_spans
from atelier.llm.quality_rules import js_distance, quality_rules
from atelier.llm.url_filter import RULES, filter_urls
from tests.conftest import SF_SMALL
from tests.llm.edges import EDGES, edge_table, empty_table, prose

WORD = r"[^\x20\x09-\x0D]+"


def rule_measures(t):
    t = t or ""
    w = re.findall(WORD, t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_rules_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {r.doc_id: rule_measures(r.text) for r in docs.collect()}
    got = registry.op8_quality_rules(spark, SF_SMALL).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == want
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_edges(spark):
    got = quality_rules(edge_table(spark, True)).select("doc_id", "text", "rules.*").collect()
    assert sorted((str(r.doc_id), rule_measures(r.text)) for r in got) == sorted((str(r.doc_id), tuple(r[c] for c in COLUMNS)) for r in got)
    assert len(got) == len(EDGES)
    empty = quality_rules(empty_table(spark))
    assert empty.count() == 0 and "rules" in empty.columns


def test_rules_reject_other_distributions(spark):
    rows = [(i, prose(i, 300), "en") for i in range(60)]
    rows += [(100, " ".join(f"W{i}$$$" for i in range(300)), "en"), (101, " | ".join(f"cell{i}" for i in range(200)), "en")]
    got = {r.doc_id: r.rules.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[100] and not got[101] and all(got[i] for i in range(60))


def test_js_distance_is_the_textbook_one():
    p, q = np.array([[3.0, 1.0, 0.0], [0, 0, 0]]), np.array([1.0, 1.0, 2.0])
    a, b = p[0] / 4, q / 4
    m = (a + b) / 2
    kl = lambda x, y: sum(i * np.log2(i / j) for i, j in zip(x, y) if i)
    assert np.allclose(js_distance(p, q), [np.sqrt((kl(a, m) + kl(b, m)) / 2), 0])


# ------------------------------------------------------------ personal data


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def only_digits(m):
    return re.sub("[^0-9]", "", m)


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(only_digits(m)) <= 15),
]


def base_spans(t):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in PLAIN for m in re.finditer(p, t or "") if ok(m.group())]


def test_personal_data_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in registry.op3_personal_data(spark, SF_SMALL).collect():
        want = base_spans(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in ("email", "ip", "card", "phone")]
        assert set(want) <= set(r.spans.split(",")) | {""}


def test_personal_data_fuzz(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("a1@.-+ ()%9é😀\n5_") for _ in range(rnd.randrange(120))) for _ in range(1500)]
    texts += ["".join(rnd.choice("0123456789 -.+(@a") for _ in range(rnd.randrange(80))) for _ in range(2500)]
    texts += ["a@b.c%x@d.e @f.g", "1.2.3.4.5.6.7.8", "1.2.3.256 001.2.3.4", "4111 1111-1111 1111", "+1" + "(" * 5000, "a" * 3000, "x@y" + ".z" * 3000, "7 " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in find_personal_data(df).select("doc_id", named_spans("found", BASE).alias("s")).collect():
        assert r.s == ",".join(base_spans(texts[r.doc_id])), texts[r.doc_id][:100]


def test_added_kinds_and_context(spark):
    texts = ["pay with visa 378282246310005 now", "number 378282246310005 here", "GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32", "version 10.0.0.1", "server 10.0.0.1"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = [r.s for r in find_personal_data(df).orderBy("i").select(named_spans("found", KINDS, True).alias("s")).collect()]
    assert got == ["card13:14:29:0.6", "", "iban:0:27:0.9", "", "ip:8:16:0.4", "ip:7:15:1.0"]


def test_personal_data_edges(spark):
    got = find_personal_data(edge_table(spark, True))
    assert got.count() == len(EDGES) and got.filter(F.size("found.email") > 0).count() == 0
    assert find_personal_data(empty_table(spark)).count() == 0


# ------------------------------------------------------------ URLs


def split_url(u):
    if not u or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule(host, path):
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return max(fits, key=len, default=None)


def test_urls_match_brute_force(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    for r in registry.op6_url_filter(spark, SF_SMALL).collect():
        want = rule(*split_url(urls[r.page_id]))
        assert (r.host, r.path, r.rule) == (*split_url(urls[r.page_id]), want)
        assert r.verdict == RULES[want] if want else r.verdict in ("allow", "block")


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "://x", "HTTP://A.NET/x", "http://a.net", "http://example.net/en/q?x#y", "http://notexample.com/de/", "http://ÀB.org/fr/", "a://b://c/d", "http://x.com?a://b/"]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, filter int")
    for r in filter_urls(df).select("page_id", "filter.*").collect():
        h, p = split_url(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (h, p, rule(h, p))
    assert filter_urls(df.limit(0)).count() == 0


def test_trees_learn_labelled_urls(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(1200):
        bad = i % 3 == 0
        host = f"{rnd.choice(['win', 'free', 'cash'])}-{rnd.randrange(1000)}-x.test" if bad else f"{rnd.choice('abc')}.{rnd.choice(['news', 'blog'])}.site"
        rows.append((f"http://{host}/" + "/".join(str(rnd.randrange(100)) for _ in range(4 if bad else 1)), float(bad)))
    labelled = spark.createDataFrame(rows[:900], "url string, label double")
    pages = spark.createDataFrame([(u, y) for u, y in rows[900:]], "url string, y double")
    got = filter_urls(pages, labelled, rules={}).collect()
    assert np.mean([(r["filter"].verdict == "block") == (r.y == 1) for r in got]) > 0.97


def test_very_many_matches_and_secrets(spark):
    """200,000 matches in one text: the places are running sums."""
    text = " ".join(f"a{i}@b.cd" for i in range(200_000))
    r = find_personal_data(spark.createDataFrame([(text,)], "text string")).select("found.email").first().email
    assert len(r) == 200_000 and all(text[x.start : x.end] == f"a{i}@b.cd" for i, x in enumerate(r) if i % 997 == 0)
    texts = ['the token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" x', "API_KEY: abcdefgh12345678", "token = short1", "password: aaaaaaaaaaaaaaaaaaaa", "mytoken=aaaa1111bbbb2222"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = [r.s for r in find_personal_data(df).orderBy("i").select(named_spans("found", tuple(k for k in KINDS if k.name == "secret")).alias("s")).collect()]
    assert got == ["secret:4:53", "secret:0:25", "", "", ""]


def test_rules_with_other_column_names(spark):
    df = edge_table(spark, True).withColumnsRenamed({"text": "body", "lang": "language"}).withColumn("lang", F.lit("zz")).withColumn("text", F.lit(1))
    a = quality_rules(df, text="body", lang="language").select("doc_id", "rules.*").collect()
    b = quality_rules(edge_table(spark)).select("doc_id", "rules.*").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_url_features_against_python(spark):
    import math
    from collections import Counter

    from atelier.llm import url_filter as U

    urls = ["https://a-b.example.com/x_1/y?q=1&r=2#f", "http://h", "no url", "", "ftp://É.org/é/7?a", "x://y/?&&", "http://aab"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = U.host_and_path(F.col("url"))
    df = df.withColumn("host", host).withColumn("path", path)
    bits = lambda s: -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values()) if s else 0.0
    for r in df.select("*", *[c.alias(f"f_{k}") for k, c in U.lexical(F.col("url"), F.col("host"), F.col("path")).items()]).collect():
        u, h, p = r.url, r.host, r.path
        assert (h, p) == split_url(u)
        q = re.search(r"\?([^#]*)", u)
        q = q.group(1) if q else ""
        want = {
            "length": len(u), "host_length": len(h), "path_length": len(p), "labels": h.count(".") + 1, "depth": p.count("/"), "digit_ratio": len(re.findall("[0-9]", u)) / max(len(u), 1),
            "hyphens": len(re.findall("[-_]", u)), "host_hyphens": h.count("-"), "parameters": q.count("&") + 1 if q else 0, "query_length": len(q), "fragment": "#" in u, "secure": u.startswith("https:"),
            "entropy": bits(u), "host_entropy": bits(h),
        }
        assert {k: round(float(v), 9) for k, v in want.items()} == {k: round(r[f"f_{k}"], 9) for k in want}


def test_trees_on_held_out_urls(spark):
    """Labels by depth and parameters; suffix shares from labelled rows only."""
    rnd = random.Random(3)
    rows = []
    for i in range(1500):
        bad = rnd.random() < 0.5
        suffix = rnd.choice(["com", "org", "zip", "zip"] if bad else ["com", "org", "com", "dev"])
        rows.append((f"http://{'h' * rnd.randrange(1, 40)}{i}.{suffix}/" + "/".join(["p"] * rnd.randrange(*((4, 9) if bad else (0, 4)))) + ("?" + "&".join(["a=1"] * 5) if bad and rnd.random() < 0.7 else ""), int(bad)))
    labelled = spark.createDataFrame([*rows[:1000], (None, 1), ("http://n.com/", None)], "url string, label int")
    got = filter_urls(spark.createDataFrame(rows[1000:], "url string, truth int"), labelled, rules={}).select("truth", "filter.*").collect()
    assert np.mean([(r.verdict == "block") == r.truth for r in got]) > 0.9
