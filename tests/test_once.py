"""Steps that must not be repeated, or not wait for each other."""

import threading

from pyspark.sql import functions as F

from versemill.models import classifiers, experiments, vectors
from versemill.operators import terms
from versemill.plans import modelling, texts


def test_words_of_ngrams_are_made_once(spark, small):
    plan = texts.ngrams(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(coalesce(text") == 1


def test_words_are_hashed_before_the_folds(spark, small, monkeypatch):
    seen = []
    monkeypatch.setattr(experiments, "grid_search", lambda searches, train, test, *a, **k: seen.append((searches, train)))
    modelling.grid_search_text(spark, small)
    searches, train = seen[0]
    assert dict(train.dtypes)["tf"] == "vector" and "words" not in train.columns
    stages = searches["naive_bayes"][0](10, smoothing=1.0).getStages()
    assert [type(s).__name__ for s in stages] == ["IDF", "NaiveBayes"]


def test_fits_of_a_sweep_run_at_once_and_equal_single_ones(spark, small, monkeypatch):
    emb = spark.read.parquet(f"{small}/embeddings.parquet").selectExpr("vec_id", "cast(embedding as array<double>) AS v").cache()
    together, plain = threading.Barrier(2), vectors.kmeans
    alone = {k: plain(emb, "v", k)[1] for k in (2, 3)}

    def waits(*args, **more):
        together.wait(60)
        return plain(*args, **more)

    monkeypatch.setattr(vectors, "kmeans", waits)
    rows = vectors.sweep(emb, "v", range(2, 4)).collect()
    assert [r["k"] for r in rows] == [2, 3]
    assert all(abs(r["inertia"] - alone[r["k"]]) < 1e-6 * alone[r["k"]] for r in rows)


def test_folds_add_up_terms_in_the_task(spark, monkeypatch):
    """No row a document and term: the terms of a fold are added up before they are moved."""
    monkeypatch.delattr(terms, "term_counts")
    word = F.element_at(F.array(*map(F.lit, ["love", "rain", "night"])), (F.col("id") % 3 + 1).cast("int"))
    rows = spark.range(60).select("id", (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 5).alias("fold"), F.array(word, F.lit("song")).alias("words")).cache()
    out = experiments.leakage_safe_folds(rows, "id", lambda: F.col("words"), "label", "fold", 1, classifiers.logistic_regression)
    assert [r[2:4] for r in out] == [("fold_0", m) for m in experiments.METRICS]
