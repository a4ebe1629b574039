import numpy as np
import pytest
from pyspark.sql import functions as F

from versemill.models import classifiers as ml
from versemill.models import experiments, vectors, wordvec
from versemill.operators import encoding, metrics
from versemill.plans import modelling


QUICK = ml.Settings(iterations=50, tree_depth=5, trees=10, forest_depth=5, rounds=5, boost_depth=3)


@pytest.fixture(scope="module")
def rows(spark, small):
    return modelling.embedding_rows(spark, small).cache()


@pytest.mark.parametrize("make", [
    lambda n: ml.logistic_regression(n, settings=QUICK),
    lambda n: ml.linear_svm(n, settings=QUICK),
])
def test_fit_twice_gives_the_same(rows, make):
    n = rows.count()
    fits = [make(n).fit(rows).transform(rows).orderBy("vec_id").select("prediction").collect() for _ in range(2)]
    assert fits[0] == fits[1]
    scores = ml.score(make(n).fit(rows).transform(rows))
    assert scores["accuracy"] > 0.6


def test_auc_floor(rows):
    """A label that follows from the vectors is found again on rows not trained on."""
    signal = F.get("embedding", F.lit(0)) + F.get("embedding", F.lit(1)) - F.get("embedding", F.lit(2))
    marked = rows.withColumn("label", (signal > 0).cast("int"))
    train, test = marked.filter("part = 'train'"), marked.filter("part = 'test'")
    predicted = ml.logistic_regression(train.count(), settings=QUICK).fit(train).transform(test)
    scored = predicted.withColumn("score", vectors.vector_to_array("probability")[1])
    assert metrics.roc_auc(scored, "score", "label").head()["auc"] > 0.9


def test_saved_model_predicts_the_same(spark, small):
    row = modelling.model_save_load(spark, small).head()
    assert row["n"] > 0 and row["n_different"] == 0


def test_mlp_keeps_the_best_stage(rows):
    model = ml.train_mlp(rows, rows, [8], 64, steps=2, iterations=5)
    assert model.getLayers() == [64, 8, 2]
    stages = [ml.score(ml.train_mlp(rows, rows, [8], 64, steps=n, iterations=5).transform(rows))["f1"] for n in (1, 2)]
    assert ml.score(model.transform(rows))["f1"] == max(stages)


def test_projection_is_centred_and_orthogonal(spark, small):
    emb = spark.read.parquet(f"{small}/embeddings.parquet")
    projected, share = vectors.project(emb, "embedding", 5)
    matrix = np.array([r["projected"] for r in projected.collect()])
    covariance = matrix.T @ matrix / (len(matrix) - 1)
    assert np.allclose(matrix.mean(axis=0), 0, atol=1e-6)
    assert np.allclose(covariance - np.diag(np.diag(covariance)), 0, atol=1e-6)
    assert list(share) == sorted(share, reverse=True)


def test_inertia_falls_and_best_is_marked(spark, small):
    emb = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding")
    out = vectors.sweep(emb, "embedding", range(2, 6)).orderBy("k").collect()
    assert out[0]["inertia"] > out[-1]["inertia"]
    best = [r for r in out if r["best"]]
    assert len(best) == 1 and best[0]["silhouette_squared"] == max(r["silhouette_squared"] for r in out)


def test_documents_without_known_words_are_zero(spark):
    words = [(1, ["sun", "moon"]), (2, ["sun", "rare"]), (3, ["odd"]), (4, []), (5, ["moon", "sun"])]
    df = spark.createDataFrame(words, "id int, w array<string>")
    out = {r["id"]: np.array(r["vector"]) for r in vectors.word2vec_embed(df, "id", "w", size=4, partitions=1).collect()}
    assert len(out) == 5 and not out[3].any() and not out[4].any()
    assert np.allclose(out[1], out[5]) and np.linalg.norm(out[2]) > 0
    again = {r["id"]: np.array(r["vector"]) for r in vectors.word2vec_embed(df, "id", "w", size=4, partitions=1).collect()}
    assert np.allclose(out[1], again[1])


def test_rare_words_count_as_often_as_they_occur(spark):
    df = spark.createDataFrame([(1, ["sun"]), (2, ["sun", "rare", "rare"]), (3, ["sun", "sun"])], "id int, w array<string>")
    out = {r["id"]: np.array(r["vector"]) for r in vectors.word2vec_embed(df, "id", "w", size=4, min_count=3, partitions=1).collect()}
    assert np.allclose(out[1], out[2]) and np.allclose(out[1], out[3]) and out[1].any()


def test_no_vocabulary_reaches_the_driver(spark, monkeypatch):
    """The vectors of words and their names stay in the tasks, and blocks are fitted each by itself."""

    def gone(self, *args):
        raise AssertionError("a table came to the driver")

    df = spark.createDataFrame([(i, [f"w{i % 40}", f"w{i % 7}", "all"]) for i in range(80)], "id int, w array<string>")
    for name in ("collect", "toPandas", "toArrow", "toLocalIterator"):
        monkeypatch.setattr(type(df), name, gone)
    embedded = vectors.word2vec_embed(df, "id", "w", size=4, partitions=5, iterations=2)
    assert embedded.filter("size(vector) = 4 AND vector[0] <> 0").count() == 80
    # MLlib's model is collected within the JVM, where the calls above do not see it.
    assert embedded._jdf.queryExecution().toString().count("FlatMapCoGroupsInArrow") >= 1


def test_words_of_one_subject_are_near(spark):
    """Two subjects with words of their own, in several blocks, and what is common to both."""
    rng = np.random.default_rng(3)
    rows = [(i, [f"s{i % 2}x{w}" if w < 20 else f"both{w}" for w in rng.integers(0, 25, 40)]) for i in range(1200)]
    df = spark.createDataFrame([*rows, *[(2000 + 20 * s + w, [f"s{s}x{w}"]) for s in (0, 1) for w in range(20)]], "id int, w array<string>")
    out = {r["id"]: np.array(r["vector"]) for r in vectors.word2vec_embed(df, "id", "w", size=16, partitions=4, iterations=5).collect()}
    unit = np.array([out[2000 + i] / np.linalg.norm(out[2000 + i]) for i in range(40)])
    near = unit @ unit.T
    own = np.concatenate([near[:20, :20][~np.eye(20, dtype=bool)], near[20:, 20:][~np.eye(20, dtype=bool)]])
    assert own.mean() > near[:20, 20:].mean() + 0.3


def test_word_mean_is_over_known_words(spark):
    df = spark.createDataFrame([(1, ["sun"]), (2, ["sun", "rare", "other"])], "id int, w array<string>")
    out = {r["id"]: np.array(r["vector"]) for r in vectors.word2vec_embed(df, "id", "w", size=4, partitions=1).collect()}
    assert np.allclose(out[1], out[2])


def test_constant_columns(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "a double, b double")
    assert [r["a"] for r in encoding.minmax_apply(df, df, ["a", "b"]).collect()] == [0.0, 0.0]
    assert [r["a"] for r in encoding.standardize(df, df, ["a", "b"]).collect()] == [0.0, 0.0]


def test_mean_pool_of_an_empty_mask(spark):
    df = spark.createDataFrame([(1, [2.0, 4.0], 0)], "g int, v array<double>, m int")
    assert [r["value"] for r in encoding.mean_pool(df, "g", "v", F.col("m")).collect()] == [0.0, 0.0]


def test_many_dense_categories(spark):
    df = spark.createDataFrame([(i, f"c{i:05d}") for i in range(1500)] + [(2000, None)], "id int, c string")
    out = {r["id"]: r["indicators"] for r in encoding.dummies_align(df.filter("id < 1400"), df, "id", "c").collect()}
    assert all(out[i].index(1) == i and sum(out[i]) == 1 and len(out[i]) == 1400 for i in range(0, 1400, 99))
    assert sum(out[1450]) == 0 and sum(out[2000]) == 0


def test_penalty_follows_the_fitted_rows(rows):
    """On a part of the rows C = 1 is the penalty of that part."""
    part = rows.filter("vec_id % 3 = 0")
    model = experiments.fit_on(ml.logistic_regression, part)
    assert model.getRegParam() == 1 / part.count()


def test_one_hot_vectors_of_unknown_values_are_zero(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None)], "id int, c string")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "x"), (4, None)], "id int, c string")
    out = {r["id"]: r["v"].toArray().tolist() for r in experiments.one_hot_vectors(train, df, "id", "c", "v").collect()}
    assert out == {1: [0.0, 1.0], 2: [1.0, 0.0], 3: [0.0, 0.0], 4: [0.0, 0.0]}


def test_column_vectors_choose_a_form_per_column(spark):
    rows = [(i, float(i), ["sun rise", "moon"][i % 2], f"Name {i % 4}") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, x double, words string, name string")
    out = experiments.column_vectors(df, df, "id", ["x"], ["words", "name"]).orderBy("id").collect()
    assert out[39]["v_x"][0] == 1.0 and len(out[0]["v_words"]) == 4 and len(out[0]["v_name"]) == 4


@pytest.mark.parametrize("words", [1, 2, 3000])
def test_repeated_words_do_not_carry_vectors_away(words):
    """Words with hundreds of pairs in a step, of one text or of many, keep vectors of moderate length."""
    share = 1 / np.arange(1, words + 1)
    codes = np.random.default_rng(1).choice(words, 20_000, p=share / share.sum())
    inner = wordvec.starts(np.arange(words), 16)
    outer = np.zeros_like(inner)
    for seed in range(3):
        wordvec.train(codes, np.repeat(np.arange(100), 200), inner, outer, 5, seed)
    assert np.abs(inner).max() < 10 and np.abs(outer).max() < 10 and np.abs(inner - wordvec.starts(np.arange(words), 16)).max() > 0


def test_words_of_repeated_texts_have_finite_vectors(spark):
    df = spark.createDataFrame([(i, ["again"] * 400) for i in range(40)], "id int, w array<string>")
    out = vectors.word2vec_embed(df, "id", "w", size=4, partitions=2)
    assert all(np.isfinite(r["vector"]).all() and any(r["vector"]) for r in out.collect())


@pytest.mark.parametrize("iterations", [1, 2])
def test_blocks_in_turns_give_the_same_vectors(spark, monkeypatch, iterations):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, [f"w{w}" for w in rng.zipf(1.4, 30) % 200]) for i in range(120)] + [(500, ["single"]), (501, None)], "id int, w array<string>")
    embed = lambda: {r["id"]: np.array(r["vector"]) for r in vectors.word2vec_embed(df, "id", "w", size=6, partitions=5, iterations=iterations).collect()}
    want, written, gone, cut, drop = embed(), [], [], wordvec.cut_lineage, wordvec.discard
    monkeypatch.setattr(wordvec, "TURN_BLOCKS", 2)
    monkeypatch.setattr(wordvec, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    monkeypatch.setattr(wordvec, "discard", lambda df: (df is not None and gone.append(df.columns)) or drop(df))
    got = embed()
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], atol=1e-5) for i in want)
    # Three turns an iteration; of the vectors of words only the last table stays.
    assert written.count(["word", "n", "vectors"]) == 3 * iterations and gone.count(["word", "n", "vectors"]) == 3 * iterations - 1
