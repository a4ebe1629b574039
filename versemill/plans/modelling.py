"""Fits on whole tables with the full model sizes."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, MinMaxScaler
from pyspark.sql import functions as F

from versemill.functions.parsing import label_lower_yes, parse_release_date, release_decade
from versemill.models import classifiers as ml
from versemill.models import experiments, gauss, linear, lines, nets, trees
from versemill.models import vectors as vec
from versemill.operators import metrics, nearest, sampling, terms
from versemill.plans.registry import query, table
from versemill.plans.views import SONGS, songs
from versemill.session import cut_lineage, spread, work_folder

FOLDS = 5


def embedding_rows(spark, folder):
    """(vec_id, label 0/1, features, part, fold): the upper five labels are the positive class."""
    rows = table(spark, folder, "embeddings").select(
        "vec_id", (F.col("label") >= 5).cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    split = sampling.split_stratified(rows, "vec_id", "label")
    folded = sampling.kfold_stratified(split, "vec_id", "label", FOLDS, seed=7)
    return ml.with_vector(cut_lineage(folded), "embedding")


def _parts(rows):
    train, test = (rows.filter(F.col("part") == p) for p in ("train", "test"))
    return train, test, train.count()


def _tested(spark, folder, make):
    """Fit on train, score on test: one row of metrics."""
    train, test, n = _parts(embedding_rows(spark, folder))
    predicted = make(n).fit(train).transform(test)
    return metrics.binary_metrics(predicted, "label", "prediction")


@query("logistic_regression")
def logistic_regression(spark, folder):
    train, test, n = _parts(embedding_rows(spark, folder))
    predicted = ml.logistic_regression(n).fit(train).transform(test)
    scored = predicted.withColumn("score", vec.vector_to_array("probability")[1])
    auc = metrics.roc_auc(scored, "score", "label").head()["auc"]
    return metrics.binary_metrics(scored, "label", "prediction").withColumn("auc", F.lit(auc))


@query("logistic_regression_l1")
def logistic_regression_l1(spark, folder):
    return _tested(spark, folder, lambda n: ml.logistic_regression(n, penalty="l1"))


@query("linear_svm")
def linear_svm(spark, folder):
    return _tested(spark, folder, lambda n: ml.linear_svm(n))


def _trees_tested(spark, folder, name):
    rows = embedding_rows(spark, folder)
    train, test, _ = _parts(rows)
    _, tested = experiments.joint_scores({name: _fits(rows)[name]}, train, test, "embedding", "label", "vec_id", None, 0)[name]
    return spark.createDataFrame([tuple(float(tested[m]) for m in experiments.METRICS)], ", ".join(f"{m} double" for m in experiments.METRICS))


def _fits(rows):
    return ml.joint_fits(len(rows.select("embedding").head()["embedding"]))


@query("decision_tree")
def decision_tree(spark, folder):
    return _trees_tested(spark, folder, "decision_tree")


@query("random_forest")
def random_forest(spark, folder):
    return _trees_tested(spark, folder, "random_forest")


@query("gradient_boosting")
def gradient_boosting(spark, folder):
    return _trees_tested(spark, folder, "gradient_boosting")


def _root_sql(gain: str, least: str) -> str:
    """The best cut of all features at their quantiles, by whole sums."""
    shares = ", ".join(f"{i}/{trees.BINS}::DOUBLE" for i in range(1, trees.BINS))
    return f"""WITH e AS (SELECT (label >= 5)::INT AS y, unnest(range(len(embedding)))::INT AS d, unnest(embedding)::DOUBLE AS x FROM embeddings),
      q AS (SELECT d, unnest(list_distinct(quantile_disc(x, [{shares}]))) AS c FROM e GROUP BY d),
      s AS (SELECT d, c, (count(*) FILTER (x <= c))::DOUBLE AS n, (sum(y) FILTER (x <= c))::DOUBLE AS o, count(*)::DOUBLE AS nn, sum(y)::DOUBLE AS oo
            FROM e JOIN q USING (d) GROUP BY d, c),
      g AS (SELECT *, round({gain}, 9) AS gain FROM s WHERE {least})
      SELECT d AS feature, n::BIGINT AS n_left, round(gain, 6) AS gain FROM g ORDER BY g.gain DESC, d, c LIMIT 1"""


def _entropy_sql(o: str, n: str) -> str:
    p = f"(({o}) / ({n}))"
    return f"({n}) * (CASE WHEN {p} > 0 THEN {p} * log2({p}) ELSE 0 END + CASE WHEN {p} < 1 THEN (1 - {p}) * log2(1 - {p}) ELSE 0 END)"


def _boost_sql(o: str, n: str) -> str:
    return f"(0.5 * ({n}) - ({o})) * (0.5 * ({n}) - ({o})) / (0.25 * ({n}) + 1)"


def _root(spark, folder, fit):
    """Feature, rows up to the cut, and gain of the first split of a fit on all rows."""
    rows = table(spark, folder, "embeddings").select("vec_id", (F.col("label") >= 5).cast("int").alias("label"), "embedding")
    model = trees.fit_trees(rows, [fit], "embedding", "label", "vec_id")
    root = model.rows.filter("node = 1").select("feature", "cut", "gain").head()
    edge = float(model.edges[root["feature"]][root["cut"]])
    below = F.get(F.col("embedding"), F.lit(root["feature"])).cast("double") <= edge
    counted = rows.agg(F.sum(below.cast("bigint")).alias("n_left"))
    return counted.select(F.lit(root["feature"]).alias("feature"), "n_left", F.round(F.lit(root["gain"]), 6).alias("gain"))


@query("tree_root_split", _root_sql(f"{_entropy_sql('o', 'n')} + {_entropy_sql('oo - o', 'nn - n')} - {_entropy_sql('oo', 'nn')}", "n < nn"))
def tree_root_split(spark, folder):
    return _root(spark, folder, trees.decision_tree("entropy", 1))


@query(
    "boosting_root_split",
    _root_sql(f"{_boost_sql('o', 'n')} + {_boost_sql('oo - o', 'nn - n')} - {_boost_sql('oo', 'nn')}", "0.25 * n >= 1 AND 0.25 * (nn - n) >= 1"),
)
def boosting_root_split(spark, folder):
    return _root(spark, folder, replace(trees.gradient_boosting(1, 1, rows=1.0), columns=1.0))


PENALTIES = [0.1, 1.0]
_NEWTON = f"""RECURSIVE long AS (SELECT vec_id, (label >= 5)::INT AS y, generate_subscripts(embedding, 1) - 1 AS d, unnest(embedding)::DOUBLE AS x FROM embeddings),
  step AS (SELECT 0 AS i, d, c, 0::DOUBLE AS w, 0::DOUBLE AS b FROM (SELECT DISTINCT d FROM long), (SELECT unnest({PENALTIES})::DOUBLE AS c)
    UNION ALL
    SELECT i + 1, d, c, w - (hb * (gx + w / c) - hm * gb) / ((hx + 1 / c) * hb - hm * hm), b - ((hx + 1 / c) * gb - hm * (gx + w / c)) / ((hx + 1 / c) * hb - hm * hm)
    FROM (SELECT i, d, c, w, b, sum((p - y) * x) AS gx, sum(p - y) AS gb, sum(p * (1 - p) * x * x) AS hx, sum(p * (1 - p)) AS hb, sum(p * (1 - p) * x) AS hm
      FROM (SELECT i, d, c, w, b, x, y, 1 / (1 + exp(-(w * x + b))) AS p FROM step JOIN long USING (d) WHERE i < 12) GROUP BY i, d, c, w, b))"""


@query(
    "logistic_single_columns",
    f"""WITH {_NEWTON} SELECT d::INTEGER AS feature, c, round(w, 4) AS weight, round(b, 4) AS intercept FROM step WHERE i = 12""",
)
def logistic_single_columns(spark, folder):
    """Weight and intercept on each feature alone, for two penalties: one fit each, all made together."""
    rows = table(spark, folder, "embeddings").select((F.col("label") >= 5).cast("int").alias("label"), "embedding")
    width = len(rows.select("embedding").head()["embedding"])
    fits = [lines.LineFit("logistic", c, (d,)) for d in range(width) for c in PENALTIES]
    model = lines.fit_lines(rows, fits, "embedding", "label", tolerance=1e-10)
    found = [(fit.columns[0], fit.c, float(w[fit.columns[0]]), float(w[-1])) for fit, w in zip(fits, model.weights)]
    kept = spark.createDataFrame(found, "feature int, c double, weight double, intercept double")
    return kept.select("feature", "c", F.round("weight", 4).alias("weight"), F.round("intercept", 4).alias("intercept"))


@query(
    "logistic_balance",
    f"""SELECT c, f::INTEGER AS left_out, count(*) AS n, sum((label >= 5)::INT)::DOUBLE AS expected, 0.0::DOUBLE AS slope
        FROM embeddings, (SELECT unnest({PENALTIES})::DOUBLE AS c), (SELECT unnest(range(-1, {FOLDS})) AS f)
        WHERE vec_id % {FOLDS} <> f GROUP BY c, f""",
)
def logistic_balance(spark, folder):
    """What holds at the optimum of each fold and penalty, counted from the scores: as many labels are
    expected as there are, and along the weights the losses and the penalty keep each other in balance."""
    rows = table(spark, folder, "embeddings").select(
        "vec_id", (F.col("label") >= 5).cast("int").alias("label"), "embedding", (F.col("vec_id") % FOLDS).cast("int").alias("fold")
    )
    rows = cut_lineage(rows)
    fits = [lines.LineFit("logistic", c, left_out=i) for c in PENALTIES for i in range(-1, FOLDS)]
    model = lines.fit_lines(rows, fits, "embedding", "label", fold="fold", tolerance=1e-9)
    sizes = [(i, fit.c, fit.left_out, float(w[-1]), float(w[:-1] @ w[:-1]) / fit.c) for i, (fit, w) in enumerate(zip(fits, model.weights))]
    known = spark.createDataFrame(sizes, "fit int, c double, left_out int, intercept double, penalty double")
    p = F.col("p")
    each = model.predict(rows, "embedding", "p").select("label", "fold", F.posexplode("p").alias("fit", "p")).join(F.broadcast(known), "fit")
    along = (p - F.col("label")) * (F.log(p / (1 - p)) - F.col("intercept"))
    summed = each.filter("fold <> left_out").groupBy("c", "left_out", "penalty").agg(
        F.count("*").alias("n"), F.round(F.sum("p"), 3).alias("expected"), F.sum(along).alias("along")
    )
    return summed.select("c", "left_out", "n", "expected", F.abs(F.round(F.col("along") + F.col("penalty"), 3)).alias("slope"))


@query("mlp")
def mlp(spark, folder):
    """The nets, each the best of its stages by F1 on a validation fold."""
    train, test, _ = _parts(embedding_rows(spark, folder))
    fit, valid = train.filter("fold <> 0"), train.filter("fold = 0")
    size = len(train.select("embedding").head()["embedding"])
    rows = []
    for name, model in nets.fit_nets(fit, valid, ml.NETS, size).items():
        rows += experiments.metric_rows("embedding", f"net_{name}", "test", ml.score(model.transform(test)))
    return experiments.result_table(spark, rows)


@query("grid_search")
def grid_search(spark, folder):
    train, test, _ = _parts(embedding_rows(spark, folder))
    joint = {
        "logistic_regression": (lambda c: lines.LineFit("logistic", c), {"c": [0.1, 1.0]}),
        "linear_svm": (lambda c: lines.LineFit("hinge", c), {"c": [0.1, 1.0]}),
        "naive_bayes": (gauss.GaussFit, {"smoothing": [1e-9, 1e-8]}),
        "decision_tree": (
            lambda impurity, depth, split, leaf: trees.decision_tree(impurity, depth, min_split=split, min_leaf=leaf),
            {"impurity": ["gini", "entropy"], "depth": [4, 5, 6, 7, 10], "split": [2, 5], "leaf": [1, 2]},
        ),
        "gradient_boosting": (lambda depth, share: trees.gradient_boosting(200, depth, share), {"depth": [6, 8], "share": [0.7, 0.8]}),
    }
    return experiments.grid_search({}, train, test, "label", "fold", FOLDS, joint=joint)


@query("grid_search_text")
def grid_search_text(spark, folder):
    """Naive Bayes on hashed TF-IDF; the weights are fitted inside each fold."""
    rows = _labelled_songs(spark, folder).select("doc_id", "text", "label", "part")
    folded = sampling.kfold_stratified(spread(rows, "doc_id"), "doc_id", "label", FOLDS, seed=7)
    words = folded.withColumn("words", terms.preprocess(F.col("text"))).drop("text")
    # Counts of hashed words need no fit: they are made once, not in every fold and setting.
    counts = cut_lineage(HashingTF(numFeatures=4096, inputCol="words", outputCol="tf").transform(words).drop("words"))
    train, test = (counts.filter(F.col("part") == p) for p in ("train", "test"))

    def bayes(n, smoothing):
        return Pipeline(stages=[IDF(inputCol="tf", outputCol="features"), ml.naive_bayes(counts=True).setSmoothing(smoothing)])

    return experiments.grid_search({"naive_bayes": (bayes, {"smoothing": [0.5, 1.0, 2.0]})}, train, test, "label", "fold", FOLDS)


@query("cross_validate_refit")
def cross_validate_refit(spark, folder):
    train, test, _ = _parts(embedding_rows(spark, folder))
    rows = experiments.cross_validate_refit(_fits(train), train, test, "label", "fold", FOLDS, "embedding", "embedding", "vec_id")
    return experiments.result_table(spark, rows)


@query("compare_models")
def compare_models(spark, folder):
    """All models on one feature set, in order of F1."""
    train, test, _ = _parts(embedding_rows(spark, folder))
    rows = experiments.compare_models(_fits(train), train, test, "label", "embedding", "embedding", "vec_id")
    f1 = experiments.result_table(spark, rows).filter("metric = 'f1'")
    return metrics.leaderboard(f1.withColumnRenamed("value", "f1"), "feature_set", "model", "f1")


def _labelled_songs(spark, folder):
    rows = songs(spark, folder).filter("explicit IS NOT NULL")
    rows = rows.withColumn("label", label_lower_yes(F.col("explicit")))
    return sampling.split_stratified(rows, "doc_id", "label")


@query("leakage_safe_fit")
def leakage_safe_fit(spark, folder):
    rows = _labelled_songs(spark, folder).select("doc_id", "text", "label")
    folded = sampling.kfold_stratified(spread(rows, "doc_id"), "doc_id", "label", FOLDS, seed=7)
    words = lambda: terms.preprocess(F.col("text"))
    out = experiments.leakage_safe_folds(folded, "doc_id", words, "label", "fold", FOLDS, ml.logistic_regression)
    return experiments.result_table(spark, out)


NUMBERS = ["popularity", "energy", "tempo"]
TEXTS = ["emotion", "genre", "artist"]


def _ablation(spark, folder, leave_out):
    rows = cut_lineage(_labelled_songs(spark, folder).select("doc_id", "label", "part", *NUMBERS, *TEXTS))
    train = rows.filter("part = 'train'")
    vectors = cut_lineage(experiments.column_vectors(train, rows, "doc_id", NUMBERS, TEXTS))
    train, test, _ = _parts(vectors)
    balanced = sampling.undersample(train, "doc_id", "label")
    result = experiments.ablation(cut_lineage(balanced), test, NUMBERS + TEXTS, ml.joint_fits, "label", "doc_id", leave_out)
    wide = experiments.result_table(spark, result).groupBy("feature_set", "model").pivot("metric", experiments.METRICS).agg(F.first("value"))
    return metrics.best_per_group(wide, "feature_set", "model", "f1")


@query("ablation_single")
def ablation_single(spark, folder):
    return _ablation(spark, folder, leave_out=False)


@query("ablation_leave_one_out")
def ablation_leave_one_out(spark, folder):
    return _ablation(spark, folder, leave_out=True)


@query(
    "model_save_load",
    """SELECT sum(n)::BIGINT AS n, 0::BIGINT AS n_different
       FROM (SELECT round(0.2::DOUBLE * count(*)) AS n FROM embeddings GROUP BY label >= 5)""",
)
def model_save_load(spark, folder):
    """Predictions of a saved and loaded model: rows, and rows that differ (none)."""
    train, test, n = _parts(embedding_rows(spark, folder))
    scale = MinMaxScaler(inputCol="features", outputCol="scaled")
    fitted = Pipeline(stages=[scale, ml.logistic_regression(n, features="scaled")]).fit(train)
    path = work_folder(spark, "model")
    fitted.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    old, new = (m.transform(test).select("vec_id", F.col("prediction").alias(name)) for m, name in ((fitted, "old"), (loaded, "new")))
    differs = (F.col("old") != F.col("new")).cast("int")
    return old.join(new, "vec_id").agg(F.count("*").alias("n"), F.sum(differs).cast("bigint").alias("n_different"))


def _embedded_documents(spark, folder, size):
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    words = cut_lineage(docs.select("doc_id", terms.preprocess(F.col("text")).alias("words")))
    return vec.word2vec_embed(words, "doc_id", "words", size=size)


@query("word2vec_embed")
def word2vec_embed(spark, folder):
    embedded = _embedded_documents(spark, folder, 100)
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    return embedded.select("doc_id", F.size("vector").alias("dim"), F.round(length, 4).alias("length"))


@query("pca")
def pca(spark, folder):
    rows, _ = vec.project(table(spark, folder, "embeddings"), "embedding", 20)
    return rows.select("vec_id", F.posexplode("projected").alias("component", "v")).select("vec_id", "component", F.round("v", 6).alias("value"))


@query(
    "hybrid_vector",
    f"""WITH {SONGS} SELECT doc_id, (20 + 3 + (SELECT count(DISTINCT coalesce(genre, 'unknown')) + count(DISTINCT coalesce(emotion, 'unknown'))
          FROM songs))::INTEGER AS dim FROM songs""",
)
def hybrid_vector(spark, folder):
    text_vectors = _embedded_documents(spark, folder, 20)
    rows = songs(spark, folder).select("doc_id", *NUMBERS, "genre", "emotion").join(text_vectors, "doc_id")
    mixed = vec.hybrid_vector(cut_lineage(rows), "vector", NUMBERS, ["genre", "emotion"])
    return mixed.select("doc_id", F.size("hybrid").alias("dim"))


@query("recommender")
def recommender(spark, folder):
    """The five songs most like each song, of its cluster and decade: vectors of text, numbers and
    categories, projected, clustered and compared in groups."""
    decade = release_decade(parse_release_date(F.col("release_date"))).alias("decade")
    rows = songs(spark, folder).select("doc_id", *NUMBERS, "genre", "emotion", decade).join(_embedded_documents(spark, folder, 20), "doc_id")
    mixed = vec.hybrid_vector(cut_lineage(rows), "vector", NUMBERS, ["genre", "emotion"]).select("doc_id", "decade", "hybrid")
    reduced, _ = vec.project(cut_lineage(mixed), "hybrid", 20)
    clustered, _ = vec.kmeans(cut_lineage(reduced), "projected", 7)
    found = nearest.most_similar(cut_lineage(clustered), "doc_id", "hybrid", 5, same=["cluster", "decade"])
    return found.select(F.col("id").alias("doc_id"), "neighbour", F.round("similarity", 6).alias("similarity"), "place")


_WHOLE = """WITH long AS (SELECT generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
  each AS (SELECT dim, var_pop(x) AS v FROM long GROUP BY dim)"""


@query("pca_facts", f"{_WHOLE} SELECT round(sum(v), 6) AS variance, 0::BIGINT AS n_correlated, 0::BIGINT AS n_out_of_order FROM each")
def pca_facts(spark, folder):
    """All components together keep the variance; no two go together; none varies more than one before it."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    dims = rows.agg(F.max(F.size("embedding"))).head()[0]
    projected = cut_lineage(vec.project(rows, "embedding", dims)[0].select("projected"))
    places = F.sequence(F.lit(0), F.lit(dims - 1))
    products = F.flatten(F.transform(places, lambda i: F.transform(F.sequence(i, F.lit(dims - 1)), lambda j: F.struct(i.alias("i"), j.alias("j"), (F.get("projected", i) * F.get("projected", j)).alias("p")))))
    sums = projected.select(F.explode(products).alias("c")).groupBy("c.i", "c.j").agg(F.avg("c.p").alias("p"))
    held = F.sort_array(F.collect_list(F.when(F.col("i") == F.col("j"), F.struct("i", "p"))))
    facts = sums.agg(F.sum(F.when(F.col("i") == F.col("j"), F.col("p"))).alias("variance"), F.count_if((F.col("i") != F.col("j")) & (F.abs("p") > 1e-9)).alias("n_correlated"), held["p"].alias("v"))
    rises = F.size(F.filter(F.zip_with(F.slice("v", 1, F.size("v") - 1), F.slice("v", 2, F.size("v")), lambda a, b: b > a + 1e-9), lambda up: up))
    return facts.select(F.round("variance", 6).alias("variance"), "n_correlated", rises.cast("bigint").alias("n_out_of_order"))


def _reduced(spark, folder):
    rows, _ = vec.project(table(spark, folder, "embeddings").select("vec_id", "embedding"), "embedding", 20)
    return cut_lineage(rows.select("vec_id", "projected"))


@query("kmeans")
def kmeans(spark, folder):
    clustered, _ = vec.kmeans(_reduced(spark, folder), "projected", 7)
    return clustered.select("vec_id", "cluster")


@query("elbow_sweep")
def elbow_sweep(spark, folder):
    return vec.sweep(_reduced(spark, folder), "projected", range(2, 20)).select("k", "inertia")


@query("best_k")
def best_k(spark, folder):
    return vec.sweep(_reduced(spark, folder), "projected", range(2, 20)).filter("best")


_FIT = """fit AS (SELECT covar_pop(l_quantity, l_extendedprice) AS qy, covar_pop(l_discount, l_extendedprice) AS dy,
    covar_pop(l_quantity, l_discount) AS qd, var_pop(l_quantity) AS qq, var_pop(l_discount) AS dd,
    avg(l_quantity) AS mq, avg(l_discount) AS md, avg(l_extendedprice) AS my FROM lineitem),
  weights AS (SELECT (qy * dd - dy * qd) / (qq * dd - qd * qd) AS wq, (dy * qq - qy * qd) / (qq * dd - qd * qd) AS wd, mq, md, my FROM fit)"""


@query(
    "linear_regression",
    f"""WITH {_FIT} SELECT round(wq, 3) AS w_quantity, round(wd, 2) AS w_discount, round(my - wq * mq - wd * md, 2) AS intercept,
          round((SELECT sqrt(avg(power(my + wq * (l_quantity - mq) + wd * (l_discount - md) - l_extendedprice, 2))) FROM lineitem), 3) AS rmse
        FROM weights""",
)
def linear_regression(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    model, rows = linear.linear_regression(lines, ["l_quantity", "l_discount"], "l_extendedprice")
    error = metrics.regression_error(rows, "l_extendedprice", "prediction")
    weights = model.coefficients.toArray().tolist()
    return error.select(
        F.round(F.lit(weights[0]), 3).alias("w_quantity"),
        F.round(F.lit(weights[1]), 2).alias("w_discount"),
        F.round(F.lit(model.intercept), 2).alias("intercept"),
        F.round("rmse", 3).alias("rmse"),
    )


@query(
    "linear_attribution",
    f"""WITH {_FIT} SELECT 'l_quantity' AS feature, round(avg(abs(wq * (l_quantity - mq))), 3) AS attribution FROM lineitem, weights
        UNION ALL SELECT 'l_discount', round(avg(abs(wd * (l_discount - md))), 3) FROM lineitem, weights""",
)
def linear_attribution(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    features = ["l_quantity", "l_discount"]
    model, _ = linear.linear_regression(lines, features, "l_extendedprice")
    parts = linear.linear_attribution(lines, dict(zip(features, model.coefficients.toArray().tolist())))
    return parts.withColumn("attribution", F.round("attribution", 3))
