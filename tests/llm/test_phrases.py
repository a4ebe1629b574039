"""Collocations: all phrases against a count of everything, border failures, odd rows."""

import random
import re
from collections import Counter

import pytest
from helpers import docs, empty, odd_rows, with_clashes

from versemill.llm import phrases


def by_counting(rows, least, top, cover=50):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            f = counts.setdefault(lang, Counter())
            for k in (1, 2, 3):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        wanted = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        longest = {}
        for h, b in wanted.items():
            for g in (h[:2], h[1:]) if len(h) == 3 else ():
                longest[g] = max(b, longest.get(g, 0))
        scored = []
        for g, a in wanted.items():
            if 100 * longest.get(g, 0) >= cover * a:
                continue
            cuts = [(1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, g, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(frame, **settings):
    return sorted(tuple(r) for r in phrases.collocations(frame, **settings).collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    kinds = [f"W{k}" if k % 3 else f"é{k}" for k in range(25)]
    marks = ["", "", "", "", ",", ".", " \n", ";", "\t", "\x0b"]
    rows = []
    for i in range(n):
        words = [rng.choice(kinds[: 3 + 22 * (rng.random() < 0.6)]) + rng.choice(marks) for _ in range(rng.randrange(25))]
        rows.append((i, " ".join(words), rng.choice(["en", "de", None]), "s", 0))
    return rows


@pytest.mark.parametrize(
    "seed,settings",
    [(2, {"share": 0.0}), (3, {"share": 0.2, "sample_least": 3, "top": 7, "most": 20})],
)
def test_equals_counting_everything(spark, seed, settings):
    """Also where the sample proposes nothing, so that all comes from border failures."""
    rows = corpus(seed)
    want = by_counting([(r[2], r[1]) for r in rows], 4, settings.get("top", 2000))
    assert want
    assert mined(docs(spark, rows).repartition(3), least=4, **settings) == want


def test_scores_beyond_64_bits(spark):
    rows = spark.createDataFrame([(4 * 10**9, 5 * 10**9, 6 * 10**9)], "a long, l long, r long")
    from pyspark.sql import functions as F

    score = rows.select(phrases.cut_score(F.col("a"), F.col("l"), F.col("r"))).head()[0]
    assert score == 10**6 * (4 * 10**9) ** 2 // (30 * 10**18)


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_rows() * 3
    want = by_counting([(r[2], r[1]) for r in rows], 3, 2000)
    plain = docs(spark, rows)
    assert mined(with_clashes(plain, "a", "b", "c", "n", "word", "words", "drawn", "rank"), least=3) == want
    assert phrases.collocations(empty(spark)).count() == 0
