"""Runs of words: both Lyndon arrays and all runs against definitions, odd rows, the query's digests."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import docs, empty, odd_rows, text, with_clashes

from __spark_entry__ import queries
from versemill.llm import runs


def runs_by_definition(words):
    """Every stretch with a smallest period that is long enough and goes no further."""
    n, found = len(words), []
    for q in range(1, n // runs.TIMES + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= max(runs.LEAST, runs.TIMES * q):
                part = words[start : start + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((start, length, q))
            start = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    kinds = rng.choice([1, 2, 2, 3, 5, 50])
    words = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(70))]
    for _ in range(rng.randrange(3)):
        if words:
            a, p = rng.randrange(len(words)), rng.randrange(1, 9)
            for i in range(a, min(len(words), a + rng.randrange(50))):
                words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("kinds", [1, 2, 3, 9])
@pytest.mark.parametrize("sign", [1, -1])
def test_lyndon_arrays(kinds, sign):
    rng = random.Random(kinds)
    for _ in range(60):
        texts = [[rng.randrange(kinds) for _ in range(rng.randrange(1, 25))] for _ in range(3)]
        codes = np.array([x for t in texts for x in [-1, *t]] + [-1])
        got, group = runs.lyndon(sign * codes, np.array([len(t) for t in texts]))
        at = 0
        for t in texts:
            t = [sign * x for x in t]
            for i in range(len(t)):
                longest = max(
                    n for n in range(1, len(t) - i + 1) if all(t[i : i + n] < t[i + k : i + n] for k in range(1, n))
                )
                assert got[at + 1 + i] == longest
                same = [j for j in range(len(t)) if group[at + 1 + j] == group[at + 1 + i]]
                assert all(t[j : j + longest] == t[i : i + longest] for j in same)
            at += len(t) + 1


@pytest.mark.parametrize("seed", range(4))
def test_equals_definition(spark, seed):
    rng = random.Random(seed)
    texts = [random_words(rng) for _ in range(150)]
    result = runs.collapse_runs(docs(spark, [(i, " ".join(w)) for i, w in enumerate(texts)])).collect()
    assert len(result) == len(texts)
    for row in result:
        words = texts[row.doc_id]
        want = runs_by_definition(words)
        assert [(r.start, r.length, r.period) for r in row.runs] == want
        assert row.collapsed == collapsed(words, want)
        if want:
            best = max(want, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
            assert tuple(row.best) == best
        else:
            assert row.best is None


def test_long_texts_with_large_and_many_periods(spark):
    turning = (text(3, 4_000, 10**6) + " ") * 5
    nested = " ".join((["a", "b"] * 4 + ["c"]) * 200)
    rows = [(1, turning), (2, "same " * 50_000), (3, nested), (4, text(4, 40_000, 300))]
    result = {r.doc_id: r for r in runs.collapse_runs(docs(spark, rows)).collect()}
    assert [tuple(r) for r in result[1].runs] == [(0, 20_000, 4_000)]
    assert [tuple(r) for r in result[2].runs] == [(0, 50_000, 1)] and result[2].collapsed == "same"
    assert [tuple(r) for r in result[3].runs] == [(0, 8, 2), (0, 1_800, 9)] + [(9 * k, 8, 2) for k in range(1, 200)]
    assert result[3].collapsed == "a b c"
    assert result[4].runs == [] and result[4].collapsed == rows[3][1]


def test_odd_rows_and_clashing_columns(spark):
    rows = docs(spark, odd_rows())
    clashing = with_clashes(rows, "runs", "best", "collapsed", "words", "start", "_key")
    plain, other = (runs.collapse_runs(d) for d in (rows, clashing))
    assert other.columns == [*rows.columns, "words", "start", "_key", "runs", "best", "collapsed"]
    key = lambda r: (str(r.doc_id), str(r.text))
    a, b = (sorted(d.collect(), key=key) for d in (plain, other))
    assert len(a) == len(odd_rows())
    assert [(r.runs, r.best, r.collapsed) for r in a] == [(r.runs, r.best, r.collapsed) for r in b]
    assert all(r.collapsed.encode() == b" ".join((r.text or "").encode().split()) for r in a if not r.runs)
    assert runs.collapse_runs(empty(spark)).count() == 0


def test_query(spark, small):
    """All rows of the query against the definition."""
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc_id, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = runs_by_definition(words)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[doc_id] = (
            len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed(words, found)),
        )
    got = {r[0]: tuple(r)[1:] for r in queries()["op12_lyndon_runs"](spark, small).collect()}
    assert got == want
    assert sum(v[0] > 0 for v in want.values()) > 5
