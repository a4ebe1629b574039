import random

import numpy as np
from helpers import docs, empty, odd_rows, text, with_clashes, words

from versemill.llm import decontam


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def test_lcs_equals_the_table_method():
    rng = random.Random(1)
    for _ in range(200):
        a = [b"%d" % rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        b = [b"%d" % rng.randrange(6) for _ in range(rng.randrange(1, 20))]
        assert decontam.lcs(a, decontam.Items._masks(b), len(b)) == plain_lcs(a, b)


def corpus(spark, n_items=12):
    """Documents of noise with items as copies, as paraphrases with and without the answer, and none."""
    rng = random.Random(3)
    items, rows, want = [], [], set()
    for i in range(n_items):
        n = rng.choice([15, 24, 40, 70, 150])
        ws = [f"b{i}x{rng.randrange(10**6)}" for _ in range(n)]
        items.append((i, " ".join(ws[:-6]) + ". " + " ".join(ws[-6:])))
    for d in range(120):
        noise = words(d, rng.randrange(0, 400), 3000)
        at = rng.randrange(len(noise) + 1)
        kind = d % 4
        if kind == 0:
            rows.append((d, " ".join(noise)))
            continue
        i = rng.randrange(n_items)
        ws = items[i][1].split()
        if kind == 2:  # every tenth word is another one
            ws = [f"z{j}" if j % 10 == 3 else w for j, w in enumerate(ws)]
        if kind == 3:  # a third of the words, but not those of the answer
            ws = [f"z{j}" if j % 3 == 1 and j < len(ws) - 6 else w for j, w in enumerate(ws)]
        want.add((d, i))
        rows.append((d, " ".join(noise[:at] + ws + noise[at:])))
    return rows, items, want


def found(df):
    return {(r["doc_id"], leak["item"]) for r in df.collect() for leak in r["leaks"]}


def test_planted_items_are_found_and_nothing_else(spark):
    rows, items, want = corpus(spark)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = found(decontam.with_leaks(docs(spark, rows), benchmark))
    assert got <= want
    assert len(got) >= 0.9 * len(want)
    exact = {(d, i) for d, i in want if d % 4 == 1}
    assert exact <= got


def test_items_in_several_blocks_give_the_same(spark, monkeypatch):
    rows, items, _ = corpus(spark)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = found(decontam.with_leaks(docs(spark, rows), benchmark))
    monkeypatch.setattr(decontam, "ITEM_BLOCK", 5)
    assert found(decontam.with_leaks(docs(spark, rows), benchmark)) == want


def test_search_against_brute_force_on_the_tables(spark, small):
    """Recall against all pairs of documents and items by longest common subsequence."""
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    got = found(decontam.with_leaks(documents, benchmark))
    want = set()
    items = [(r["item_id"], r["text"].lower().encode().split()) for r in benchmark.collect()]
    for r in documents.collect():
        ws = (r["text"] or "").lower().encode().split()
        for i, item in items:
            masks = decontam.Items._masks(item)
            step = max(1, len(item) // 2)
            if any(decontam.lcs(ws[a : a + 2 * len(item)], masks, len(item)) >= 0.8 * len(item) for a in range(0, len(ws), step)):
                want.add((r["doc_id"], i))
    assert want and len(got & want) >= 0.9 * len(want) and got <= want


def test_space_is_fitted_on_all_passages(spark):
    """Against the exact decomposition of all passages of long texts, as one matrix."""
    rows = [words(d, 1300, 500) for d in range(2)]
    items = [words(9, 40, 500)]
    texts = [" ".join(ws) for ws in rows + items]
    frame = lambda ts: spark.createDataFrame([(t,) for t in ts], "text string")
    got = decontam.fit_space(frame(texts[:2]), frame(texts[2:]))
    features = [decontam.Words([t.encode()]).features for t in texts]
    df = sum(np.bincount(np.unique(f), minlength=decontam.FEATURES) for f in features[:2])
    idf = np.log(3 / (df + 0.5)).clip(0)
    parts = [(f[i : i + decontam.PASSAGE], j) for j, f in enumerate(features) for i in range(0, len(f), decontam.PASSAGE)]
    a = np.array([np.bincount(f, minlength=decontam.FEATURES) * idf for f, _ in parts])
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    a[-1] *= np.sqrt(len(parts) - 1)
    values, vectors = np.linalg.svd(a, full_matrices=False)[1:]
    want = idf[:, None] * vectors.T / values**decontam.FLATTEN
    some = np.flatnonzero(idf)[::7]
    assert len(parts) == 43 and np.allclose(got[some] @ got[some].T, want[some] @ want[some].T, rtol=1e-2, atol=1e-3)


def test_answer_is_the_last_sentence_or_quarter():
    assert decontam.answer_words(b"who was it? it was her") == [b"it", b"was", b"her"]
    assert decontam.answer_words(b"a b c d e f g h i j k l") == [b"j", b"k", b"l"]


def test_odd_rows_and_columns(spark):
    rows = odd_rows()
    item = text(1, 30_000).split()[20_000:20_040]
    benchmark = spark.createDataFrame(
        [(1, " ".join(item)), (2, None), (3, ""), (4, "too few words"), (None, "an item without any id at all"), (5, " ".join(item))],
        "item_id long, text string",
    )
    df = with_clashes(docs(spark, rows), "leaks", "item", "id")
    out = decontam.with_leaks(df, benchmark)
    assert out.columns == [c for c in df.columns if c != "leaks"] + ["leaks"]
    assert out.count() == len(rows)
    assert found(out) == {(6, 1), (6, 5)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert found(decontam.with_leaks(empty(spark), some)) == set()
    assert found(decontam.with_leaks(docs(spark, [(1, "one two three four five six")]), none)) == set()
    assert np.isfinite(decontam.fit_space(empty(spark).select("text"), some.select("text"))).all()
