import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from versemill.functions import parsing, text
from versemill.functions.scalars import sigmoid_clip
from versemill.operators import terms
from versemill.operators.packing import next_starts


def clean(value):
    """The plain definition of cleaned text."""
    if not value:
        return ""
    value = re.sub(r"http\S+|www\S+|https\S+", "", value.lower())
    value = re.sub(r"\d+", "", re.sub(r"[^\w\s]", " ", value))
    return re.sub(r"\s+", " ", value).strip()


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from("aBñÉß 1２_.,'\n\t\u00a0-w:/htps中"), max_size=40), max_size=30))
def test_clean_text_is_its_definition(spark, values):
    assert column(spark, values, text.clean_text) == [clean(v) for v in values]


def test_clean_text_cases(spark):
    given_texts = [None, "", "  ", "See http://a.b/c?d now", "WWW.x.y z", "a1b 22 c", "l'été\u00a0là"]
    assert column(spark, given_texts, text.clean_text) == ["", "", "", "see now", "z", "ab c", "l été là"]


def test_tokens_and_contractions(spark):
    rows = column(spark, ["i cannot wanna go", "", "wannabe gonna"], text.tokenize)
    assert rows == [["i", "can", "not", "wan", "na", "go"], [], ["wannabe", "gon", "na"]]


def test_combine_text_keeps_separators(spark):
    rows = spark.createDataFrame([(None, "b", None)], "a string, b string, c string")
    assert rows.select(text.combine_text(*map(F.col, "abc"))).head()[0] == " b "


def test_section_tags(spark):
    rows = ["[Chorus 2: X] la [verse 1]la[Other]", "[Pre-Chorus]a [PreChorus] b"]
    assert column(spark, rows, text.strip_section_tags) == [" la la[Other]", "a  b"]


def test_terms_are_added_up_in_the_tasks(spark, monkeypatch):
    """Counts and frequencies against plain loops, over several pieces of a batch, with absent words
    and words that hold blanks; a term leaves a task once for many documents."""
    rows = [(i, [f"w{i % 3}", "a", "b", None, "a", "b", "a b", f"x{i % 5}"][: 8 - i % 4]) for i in range(60)]
    rows += [(60, []), (61, None), (62, [None]), (63, ["a"])]
    df = spark.createDataFrame(rows, "id long, w array<string>").coalesce(1)
    want = {}
    for i, ws in rows:
        ws = ws or []
        grams = [[w for w in ws[j : j + n]] for n in (1, 2) for j in range(len(ws) - n + 1)]
        length = len([g for g in grams if len(g) == 1 or None not in g])
        for term in {" ".join(g) for g in grams if None not in g}:
            want[i, term] = (sum(None not in g and " ".join(g) == term for g in grams), length)
    for at_once in (50, 10**6):
        monkeypatch.setattr(terms, "WORDS_AT_ONCE", at_once)
        got = terms.term_counts(df, "id", F.col("w"), 2).collect()
        assert {(r["id"], r["term"]): (r["tf"], r["length"]) for r in got} == want and len(got) == len(want)
        frequencies = terms.term_frequencies(df, F.col("w"), 2)
        assert sorted(frequencies.collect()) == sorted(terms.word_doc_frequency(terms.term_counts(df, "id", F.col("w"), 2)).collect())
    assert "MapInArrow" in frequencies._jdf.queryExecution().toString()


def test_ngrams_and_counts(spark):
    rows = spark.createDataFrame([(1, "sun sun moon"), (2, "sun"), (3, ""), (4, None)], "id int, t string")
    counts = terms.term_counts(rows, "id", terms.preprocess(F.col("t")), 2)
    got = {(r["id"], r["term"]): (r["tf"], r["length"]) for r in counts.collect()}
    assert got == {
        (1, "sun"): (2, 5), (1, "moon"): (1, 5), (1, "sun sun"): (1, 5), (1, "sun moon"): (1, 5), (2, "sun"): (1, 1),
    }


def test_vectors_equal_the_long_form(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["sun moon", "sun star", "star star moon", ""])], "id int, t string")
    words = terms.preprocess(F.col("t"))
    counts = terms.term_counts(rows, "id", words, 2)
    vocab = terms.vocabulary(terms.word_doc_frequency(counts), 4, min_df=1, max_df=1.0)
    fitted = terms.fitted_terms(vocab, 4)
    long = {(r["id"], r["term"]): r["weight"] for r in terms.tfidf_smooth_l2(counts, vocab, 4, "id").collect()}
    for r in terms.tfidf_vectors(rows, words, fitted).collect():
        dense = r["tfidf"].toArray()
        for k, (term, _) in enumerate(fitted):
            assert dense[k] == pytest.approx(long.get((r["id"], term), 0.0))


def test_parsing_edges(spark):
    assert column(spark, ["-6.85db", "x", None, "3"], parsing.parse_loudness) == [-6.85, None, None, 3.0]
    assert column(spark, ["03:21", "1:2:3", None, "a:b"], parsing.parse_length) == [201, None, None, None]
    dates = column(spark, ["29th April 2013", "1st May 1999", "bad", None], parsing.parse_release_date)
    assert [d and d.isoformat() for d in dates] == ["2013-04-29", "1999-05-01", None, None]
    assert column(spark, ["30,34%", "0%", "x"], parsing.percent_to_fraction) == [pytest.approx(0.3034), 0.0, None]
    assert column(spark, ["Yes", "yes", "No", None], parsing.label_map) == [1, None, 0, None]
    assert column(spark, ["Yes", "YES", "No", None], parsing.label_lower_yes) == [1, 1, 0, 0]


def test_sigmoid_is_clipped(spark):
    low, high = column(spark, [-1e9, 1e9], sigmoid_clip, "double")
    assert 0 < low < 1e-200 and high == 1.0


def test_task_functions_travel_without_the_package(tmp_path):
    """What a task gets must load where the package cannot be imported."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(next_starts))
    code = "import numpy, pickle; print(pickle.load(open('f.pkl', 'rb'))(numpy.array([0, 4, 9, 12]), 5, 9).tolist())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "[2, 3, 3]", done.stderr


@pytest.mark.parametrize("features", [5, 60, 100_000])
def test_vocabularies_of_folds_equal_those_counted_fold_by_fold(spark, features):
    """Frequent words, n-grams of them, terms within few rows, words with blanks, rows of no fold."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        ws = [f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randrange(0, 30))] + ["all", "for"]
        if i % 7 == 0:
            ws += ["w1 w2", None, "pair of", "words"]
        rows.append((i, ws if i % 50 else None, [0, 1, 2, 3, None, 9][i % 6]))
    df = spark.createDataFrame(rows, "id int, w array<string>, fold int")
    trains = [df.filter(F.col("fold") != i) for i in range(4)]
    sizes = [t.count() for t in trains]
    got = terms.fold_vocabularies(df, F.col("w"), "fold", 4, sizes, max_features=features)
    for i, vocab in enumerate(got):
        want = terms.vocabulary(terms.term_frequencies(trains[i], F.col("w"), 2), sizes[i], max_features=features)
        assert vocab.collect() == want.collect()


def test_rare_ngrams_are_not_moved(spark, monkeypatch):
    """Of a thousand texts with pairs of their own, only what can be kept is counted by term."""
    seen, plain = [], terms._fold_frequencies

    def counted(df, tokens, fold, k, longest, can=None):
        out = plain(df, tokens, fold, k, longest, can)
        seen.append((longest, out.count()))
        return out

    monkeypatch.setattr(terms, "_fold_frequencies", counted)
    rows = [(i, [f"w{(i * j) % 97}" for j in range(1, 30)], i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, w array<string>, fold int")
    terms.fold_vocabularies(df, F.col("w"), "fold", 5, [800] * 5, max_features=50)
    assert [n for n, _ in seen] == [1, 2] and seen[1][1] < 0.2 * terms.term_frequencies(df, F.col("w"), 2).count()
