"""Small awkward tables: nulls, empty and very long texts, ties, repeats, clashing extra columns."""

from __future__ import annotations

import random

from pyspark.sql import types as T

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
CLASH = ("id", "key", "part", "score", "h", "root", "size", "chunk", "_pii", "_id")


def prose(seed: int, n: int) -> str:
    g = random.Random(seed)
    return " ".join(g.choice(WORDS) + g.choice(("", "", ".", "er")) for _ in range(n))


def texts() -> list[str | None]:
    a, b = prose(1, 160), prose(2, 90)
    passage = prose(3, 120)
    near = a.split()
    near[40] = "changed"
    return [None, "", " \t\n ", a, a, a.upper(), " ".join(near), b, b + " tail of five more words", passage + " " + prose(4, 60),
            prose(5, 60) + " " + passage, "one two", "ONE  two", "x" * 900, "ab" * 500, prose(6, 6000), "1234", "ä ö ü ß",
            prose(7, 40) + "\n" + prose(7, 40)]


def documents(spark, rows: list | None = None):
    """doc_id, text, lang, source, n_chars and columns whose names the operators use themselves."""
    base = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    schema = T.StructType([*base, *[T.StructField(c, T.StringType()) for c in CLASH]])
    if rows is None:
        rows = [(i, t, ("en", "de", None)[i % 3], ("s1", "s2", None, "Ü")[i % 4] if i != 5 else "s1", None if t is None else len(t))
                for i, t in enumerate(texts())]
    return spark.createDataFrame([(*r, *["clash"] * len(CLASH)) for r in rows], schema).repartition(3)
