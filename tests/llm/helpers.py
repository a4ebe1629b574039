"""Small frames with the cases that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, kinds: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def text(seed: int, n: int, kinds: int = 400) -> str:
    return " ".join(words(seed, n, kinds))


def docs(spark, rows):
    """(doc_id, text) or whole rows → a frame with the columns of `documents`."""
    full = [r if len(r) == 5 else (r[0], r[1], "en", "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    """Absent values, empty and long texts, repeated rows, one id with two texts."""
    return [
        (None, "no id here at all", "en", None, None),
        (1, None, None, "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (4, "Ein Wort", "de", "b", 8),
        (5, "same text twice in a row", "en", "b", 24),
        (5, "same text twice in a row", "en", "b", 24),
        (5, "another text of the same id", "en", None, 27),
        (6, text(1, 30_000), "en", "c", None),
        (7, "é ü ß 漢字     x\x0by\x0cz", "fr", "c", 20),
    ]


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def with_clashes(df, *names):
    """Columns with names that the operators use for their own results."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("clash") for n in names})


def union_find(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


__all__ = ["DOCS", "T", "docs", "empty", "odd_rows", "text", "union_find", "with_clashes", "words"]
