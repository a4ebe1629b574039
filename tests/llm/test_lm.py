import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import docs, empty, odd_rows, text, with_clashes
from pyspark.sql import functions as F

from versemill.llm import lm


def scored(df):
    named = df.select(F.col("doc_id").alias("id"), (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 != 2).alias("flag"), "text")
    return lm.interpolated_scores(named).collect()


def learned(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2


def tokens(t):
    return [*(t or "").encode().lower().split(), None]


def brute(rows):
    """Counts and base scores in plain Python, and the tokens' counts for the model."""
    train = [tokens(t) for i, t in rows if learned(i)]
    one = Counter(w for ws in train for w in ws)
    two = Counter(p for ws in train for p in zip([None, *ws], ws))
    n, v = sum(one.values()), len(one)
    out = []
    for i, t in rows:
        ws = tokens(t)
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in ws)
        out.append((i, not learned(i), len(ws), sum(one[w] > 0 for w in ws), n, base))
    return out, one, two, n, v


def check(spark, rows):
    want, one, two, n, v = brute(rows)
    got = scored(docs(spark, rows))
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    have = sorted(((r["id"], not r["learned"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    for a, b in zip(have, sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    return got, one, two, n, v


def test_counts_and_scores_equal_brute_force(spark, monkeypatch):
    rows = [(i, text(i % 25, 20 + i % 17, 60)) for i in range(120)]
    kept = {}
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a: kept.setdefault("w", learn(*a)))
    got, one, two, n, v = check(spark, rows)
    weights = kept["w"]
    by_id = {r["id"]: r["score"] for r in got}
    for i, t in rows:
        ws, total = tokens(t), 0.0
        for h, w in zip([None, *ws], ws):
            c = one[h]
            b = int(math.log2(c)) + 1 if c else 0
            p = weights[b] @ np.array([two[h, w] / c if c else 0, one[w] / n, 1 / (v + 1)])
            total += math.log10(p)
        assert by_id[i] == pytest.approx(total)


def test_probabilities_of_a_context_add_up_to_one(spark):
    weights = lm.learn_weights(np.array([3, 5]), np.array([10.0, 5.0]), np.array([0.5, 0.1]), np.array([0.01, 0.02]), 0.001)
    assert np.allclose(weights.sum(1), 1) and weights[0, 0] == 0 and (weights[:, 2] > 0).all()


def test_em_raises_the_likelihood():
    rng = np.random.default_rng(2)
    two, one, n = rng.random(50), rng.random(50) / 50, rng.integers(1, 9, 50).astype(float)
    bucket = rng.integers(1, 4, 50)
    w = lm.learn_weights(bucket, n, two, one, 1e-3)
    like = lambda w: (n * np.log((w[bucket] * np.stack([two, one, np.full(50, 1e-3)], 1)).sum(1))).sum()
    assert like(w) >= like(np.full((lm.BUCKETS, 3), 1 / 3))


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = [(i, " ".join(text(s, 12, 300) for s in ((i * 7) % 20, (i * 3) % 20))) for i in range(300)]
    got = [r for r in scored(docs(spark, rows)) if not r["learned"]]
    assert got and sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_odd_rows(spark):
    rows = odd_rows()
    df = with_clashes(docs(spark, rows), "id", "flag", "words", "codes", "block")
    assert len(scored(df)) == len(rows)
    check(spark, [r[:2] for r in rows])


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = [(i, text(i, 15, 30)) for i in range(40)]
    small = lm.token_blocks
    monkeypatch.setattr(lm, "token_blocks", lambda df, ends: small(df, ends, 50))
    check(spark, rows)


def test_nothing_learned_and_empty_table(spark):
    only = next(i for i in range(100) if not learned(i))
    got = scored(docs(spark, [(only, "a b c")]))
    assert got[0]["train_tokens"] == 0 and got[0]["n_known"] == 0 and got[0]["base_score"] == 0
    assert math.isfinite(got[0]["score"])
    assert scored(empty(spark)) == []
