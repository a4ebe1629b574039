import random
import zlib

import pytest
from helpers import docs, empty, odd_rows, text, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from versemill.llm import toxicity


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


ENTRIES = ["abcab", "bcabca", "aabbccabc", "abca", "ccc*", "bacab"]
AUTOMATON = toxicity.LexiconAutomaton(ENTRIES)


@settings(max_examples=400, deadline=None)
@given(st.text("abcx", max_size=12))
def test_automaton_equals_edit_distance(word):
    near = sorted(
        (edit(word, e), e) for e in ENTRIES if not e.endswith("*") and edit(word, e) <= toxicity.allowed_errors(e)
    )
    want = (near[0][1], near[0][0]) if near else None
    if word.startswith("ccc") and (want is None or want[1] > 0):
        want = ("ccc*", 0)
    assert AUTOMATON.match(word) == want


def labelled(spark, n=400):
    rng = random.Random(2)
    bad = ["gruesomeword", "vileterm", "nastything"]
    rows, labels = [], []
    for i in range(n):
        ws = text(i, 60, 900).split()
        toxic = int(i % 5 == 0)
        if toxic:
            ws[rng.randrange(60)] = rng.choice(bad) if i % 2 else "slur" + rng.choice("abcdefgh") + str(i)
        rows.append((i, " ".join(ws)))
        labels.append((i, 1, toxic))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents(spark):
    rows, labels = labelled(spark)
    df = docs(spark, rows)
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = toxicity.fit(df, labels, learn)
    assert {"gruesomeword", "vileterm", "nastything", "slur*"} == set(model.entries)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((scores[i] >= 0.5) == (i % 5 == 0) for i in held)


def test_misspelled_terms_and_quotations():
    model = toxicity.Model(entries={"gruesomeword": 0.99, "vileterm": 0.98}, near={"vileterms": 0.1}, near_entry={"gruesomeword": 0.67, "vileterm": 0.67}, base=0.01)
    memory = toxicity.Memory(toxicity.LexiconAutomaton(sorted(model.entries)))
    score = lambda t: toxicity.score_text(toxicity.hits_of(t, memory), model)
    assert score("you grusomeword") >= 0.5 and score("you are VILETERM.") >= 0.9
    assert score("vileterms") < 0.5  # seen in clean texts
    assert score("words that are clean") == pytest.approx(0.01)
    assert score('they called him a "vileterm" there') < 0.5 < score('a "quotation" and vileterm')
    assert score("she said vileterm") < score("vileterm")


def test_bounded_sample(spark):
    rows, labels = labelled(spark)
    model = toxicity.fit(docs(spark, rows), labels, F.lit(True), max_labelled=200)
    assert 0 < len(model.entries) <= 5


def test_odd_rows_without_labels(spark):
    rows = odd_rows()
    df = with_clashes(docs(spark, rows), "score", "toxic", "feature")
    none = spark.createDataFrame([(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, none, F.lit(True))
    out = toxicity.score(df, model)
    assert out.columns == [c for c in df.columns if c != "score"] + ["score"]
    assert [r["score"] for r in out.collect()] == [0.0] * len(rows)


def test_several_labels_of_one_id(spark):
    rows, _ = labelled(spark, 60)
    labels = spark.createDataFrame([(i, 0, t) for i, _ in rows for t in (0, int(i % 5 == 0))], "doc_id long, quality int, toxic int")
    sample = toxicity._labelled(docs(spark, rows), labels, F.lit(True), "doc_id", "text", 1000)
    assert sample.groupBy().sum("toxic").head()[0] == 12 and sample.count() == 60


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(empty(spark), toxicity.fit(empty(spark), none, F.lit(True))).collect() == []
