"""Rows that every operator must take: nulls in each column, empty and long
texts, ties, repeated rows, and columns whose names operators use."""

import random

WORDS = "the of and to in a is that for it as was with be by on not he this are river stone light paper window garden engine market winter letter".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        w = rnd.choice(WORDS) if rnd.random() < 0.5 else "".join(rnd.choice("abcdefghilmnoprstu") for _ in range(rnd.randrange(4, 9)))
        out.append(w + ("." if i % 12 == 11 else ""))
    return " ".join(out)


LONG = prose(1, 40_000)
COPY = prose(2, 120)
EDGES = [
    (1, COPY, "en", "a", 1),
    (2, COPY, "en", "a", 2),
    (3, COPY + " one more", "en", "b", 3),
    (3, COPY + " one more", "en", "b", 3),
    (4, "", "en", "b", 0),
    (5, None, "en", "b", 0),
    (6, " \n\t ", "fr", "b", 0),
    (7, "word", "fr", "c", 0),
    (8, LONG, "en", "c", 5),
    (9, "é" * 3000, "de", None, 5),
    (10, prose(3, 200), None, None, None),
    (None, prose(4, 200), "xx", "a", 7),
    (None, None, None, None, None),
    (12, "😀 naïve\nnaïve\n\nnaïve 😀\x1f\x85", "es", "", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASH = ["rules", "hits", "found", "toxicity", "quality", "filter", "repeats", "score", "rid", "key", "row", "size", "h", "Hits", "_key", "text_key", "nid", "words", "set_id", "component", "RULES"]


def edge_table(spark, clash: bool = False):
    df = spark.createDataFrame(EDGES, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        names = list({n.lower(): n for n in CLASH}.values())
        df = df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    return df


def empty_table(spark):
    return spark.createDataFrame([], SCHEMA)


def shape(rows):
    return sorted(map(str, rows))
