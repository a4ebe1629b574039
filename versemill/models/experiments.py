"""Experiments: cross-validation, grid search, comparison, ablation.

Fits of a kind (trees, linear models, Gaussian naive Bayes) are made together, all folds and
parameter sets at once, on a prepared table, which callers keep as a written table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.feature import MaxAbsScaler, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from versemill.models import gauss, lines, trees
from versemill.models.classifiers import score
from versemill.operators import encoding, metrics, sampling, terms
from versemill.operators.ranking import join_small
from versemill.session import cut_lineage

METRICS = ["accuracy", "precision", "recall", "f1"]
#: Settings of one fit of a kind that is fitted together.
Fit = trees.TreeFit | lines.LineFit | gauss.GaussFit
RESULT = "feature_set string, model string, part string, metric string, value double"


def metric_rows(feature_set: str, model: str, part: str, values: dict) -> list[tuple]:
    return [(feature_set, model, part, m, float(values[m])) for m in METRICS]


def result_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(feature_set, model, part, metric, value)"""
    return spark.createDataFrame(rows, RESULT)


def fit_on(make: Callable[[int], Estimator], train: DataFrame):
    """Fit the estimator that `make` gives for the number of rows that are fitted."""
    return make(train.count()).fit(train)


#: Kinds of fits of which many are made together, by the type of their settings.
TOGETHER = {trees.TreeFit: trees.fit_trees, lines.LineFit: lines.fit_lines, gauss.GaussFit: gauss.fit_gauss}


def joint_scores(
    fits: dict[str, Fit], train: DataFrame, test: DataFrame, vec_col: str, label: str, key: str, fold: str | None, k: int
) -> dict[str, tuple[list[dict], dict]]:
    """name → (metrics on each fold by the fit without it, metrics on the test rows by the fit on all).

    All folds of all fits of a kind are made together, and all their predictions are counted in two jobs.
    """
    out: dict[str, tuple[list[dict], dict]] = {}
    for kind, fit_all in TOGETHER.items():
        held = {name: fit for name, fit in fits.items() if isinstance(fit, kind)}
        if held:
            out |= _scores_of(fit_all, held, train, test, vec_col, label, key, fold, k)
    return {name: out[name] for name in fits}


def _scores_of(fit_all, fits, train, test, vec_col, label, key, fold, k) -> dict[str, tuple[list[dict], dict]]:
    plan = [(name, i) for name in fits for i in [*range(k), -1]]
    model = fit_all(train, [replace(fits[name], left_out=i) for name, i in plan], vec_col, label, key, fold)

    def counted(df: DataFrame, held: Column) -> dict[int, dict]:
        used = df.select(vec_col, label, *([fold] if fold else []))
        each = model.predict(used, vec_col, "_scores").select(label, *([fold] if fold else []), F.posexplode("_scores").alias("_fit", "_score"))
        each = each.withColumn("_out", F.get(F.array(*[F.lit(i) for _, i in plan]), F.col("_fit"))).filter(held)
        rows = metrics.binary_metrics(each.withColumn("_said", trees.predicted(F.col("_score"))), label, "_said", "_fit").collect()
        return {r["_fit"]: r.asDict() for r in rows}

    tested = counted(test, F.col("_out") == -1)
    seen = counted(train, F.col(fold) == F.col("_out")) if k else {}
    out: dict[str, tuple[list[dict], dict]] = {name: ([], {}) for name in fits}
    for number, (name, i) in enumerate(plan):
        if i < 0:
            out[name] = (out[name][0], tested[number])
        else:
            out[name][0].append(seen[number])
    return out


def compare_models(
    fits: dict[str, Fit], train: DataFrame, test: DataFrame, label: str, feature_set: str, vec_col: str, key: str
) -> list[tuple]:
    """Fit each model on the training part and score it on the test part; those of a kind together."""
    out = []
    for name, (_, tested) in joint_scores(fits, train, test, vec_col, label, key, None, 0).items():
        out += metric_rows(feature_set, name, "test", tested)
    return out


def cross_validate_refit(
    fits: dict[str, Fit], train: DataFrame, test: DataFrame, label: str, fold: str, k: int, feature_set: str, vec_col: str, key: str
) -> list[tuple]:
    """Per model: mean and population deviation over folds, then a fit on all training rows."""
    out = []
    for name, (seen, tested) in joint_scores(fits, train, test, vec_col, label, key, fold, k).items():
        for part, summary in (("cv_mean", np.mean), ("cv_std", np.std)):
            out += metric_rows(feature_set, name, part, {m: round(float(summary([s[m] for s in seen])), 4) for m in METRICS})
        out += metric_rows(feature_set, name, "test", tested)
    return out


def _search_rows(name: str, sets: list[dict], means: list[float], test_f1: Callable[[int], float]) -> list[tuple]:
    best = max(range(len(sets)), key=lambda i: means[i])
    tested = float(test_f1(best))
    shown = [", ".join(f"{p}={v}" for p, v in sorted(params.items())) for params in sets]
    return [(name, shown[i], means[i], i == best, tested if i == best else None) for i in range(len(sets))]


def grid_search(
    searches: dict[str, tuple[Callable[..., Estimator], dict[str, list]]],
    train: DataFrame,
    test: DataFrame,
    label: str,
    fold: str,
    k: int,
    parallelism: int = 4,
    joint: dict[str, tuple[Callable[..., Fit], dict[str, list]]] | None = None,
    vec_col: str = "embedding",
    key: str = "vec_id",
) -> DataFrame:
    """(model, params, f1, best, test_f1): mean F1 over the folds for each parameter set; the best
    set of each model is fitted on all training rows and scored on the test rows.

    A search is a function of (rows fitted, parameters by name) and the values of each parameter.
    Those in `joint` take the parameters alone; all their sets and folds are fitted together.
    """
    sizes = {r[fold]: r["count"] for r in train.groupBy(fold).count().collect()}
    total = sum(sizes.values())

    def fold_score(job) -> float:
        make, params, i = job
        model = make(total - sizes.get(i, 0), **params).fit(train.filter(F.col(fold) != i))
        return score(model.transform(train.filter(F.col(fold) == i)), label)["f1"]

    rows = []
    sets = {name: [dict(zip(grid, values)) for values in product(*grid.values())] for name, (_, grid) in ((joint or {}) | searches).items()}
    fits = {(name, i): make(**params) for name, (make, _) in (joint or {}).items() for i, params in enumerate(sets[name])}
    scored = joint_scores(fits, train, test, vec_col, label, key, fold, k)
    for name in joint or {}:
        means = [float(np.mean([s["f1"] for s in scored[name, i][0]])) for i in range(len(sets[name]))]
        rows += _search_rows(name, sets[name], means, lambda best: scored[name, best][1]["f1"])
    for name, (make, _) in searches.items():
        with ThreadPool(parallelism) as pool:
            scores = pool.map(fold_score, [(make, params, i) for params in sets[name] for i in range(k)], chunksize=1)
        means = [float(np.mean(scores[i * k : (i + 1) * k])) for i in range(len(sets[name]))]
        rows += _search_rows(name, sets[name], means, lambda best: score(make(total, **sets[name][best]).fit(train).transform(test), label)["f1"])
    return train.sparkSession.createDataFrame(rows, "model string, params string, f1 double, best boolean, test_f1 double")


def leakage_safe_folds(
    df: DataFrame,
    id_col: str,
    words: Callable[[], object],
    label: str,
    fold: str,
    k: int,
    estimator: Callable[[int], Estimator],
) -> list[tuple]:
    """Inside each fold: vocabulary, scale, balance and classifier see its training rows only.

    The words of the rows are made and moved once for all folds: what is counted or drawn in a fold
    is done from written rows, without their words where these are not needed.
    """
    rows = cut_lineage(df.select(id_col, label, fold, words().alias("_words"), F.monotonically_increasing_id().alias("_row")))
    outside = [rows.filter(F.col(fold) != i) for i in range(k)]
    sizes = [train.count() for train in outside]
    vocabularies = terms.fold_vocabularies(rows, F.col("_words"), fold, k, sizes)
    # The balanced rows are chosen by id and label alone, before they become vectors.
    drawn = [sampling.undersample(train.select(id_col, label, "_row"), id_col, label).select("_row", F.lit(i).alias("_in")) for i, train in enumerate(outside)]
    drawn = reduce(DataFrame.unionByName, drawn).groupBy(F.col("_row").alias("_drawn")).agg(F.collect_set("_in").alias("_in"))
    balanced = cut_lineage(rows.join(drawn, F.col("_row") == F.col("_drawn")))
    out = []
    for i, (train, n, vocab) in enumerate(zip(outside, sizes, vocabularies)):
        fitted = terms.fitted_terms(vocab, n)
        kept, valid = balanced.filter(F.array_contains("_in", i)), rows.filter(F.col(fold) == i)
        whole, kept, held_out = (terms.tfidf_vectors(part, F.col("_words"), fitted) for part in (train, kept, valid))
        scaler = MaxAbsScaler(inputCol="tfidf", outputCol="features").fit(whole)
        model = fit_on(estimator, scaler.transform(kept))
        out += metric_rows("tfidf", "undersampled", f"fold_{i}", score(model.transform(scaler.transform(held_out)), label))
    return out


def one_hot_vectors(train: DataFrame, df: DataFrame, id_col: str, column: str, out: str) -> DataFrame:
    """Sparse indicators of the categories of `train`, however many; others give all zeros.

    The codes are a table joined by value, not a list of labels on the driver.
    """
    codes = encoding.ordinal_codes(train, id_col, column)
    known = codes.withColumn("_code", F.col("code").cast("double")).drop("code")
    encoder = OneHotEncoder(inputCols=["_code"], outputCols=[out], handleInvalid="keep").fit(known)
    coded = join_small(df, known, [column], "left").na.fill(float(encoder.categorySizes[0]), ["_code"])
    return encoder.transform(coded).drop("_code")


def column_vectors(
    train: DataFrame, df: DataFrame, id_col: str, numeric: Iterable[str], texts: Iterable[str]
) -> DataFrame:
    """`df` with one vector column `v_<column>` per feature column, fitted on `train`.

    Numbers are scaled to the range of `train`; short texts become TF-IDF, with stop words if
    nothing else is left, and indicators if there are no terms at all.
    """
    numeric = list(numeric)
    out = encoding.minmax_apply(train.na.fill(0, numeric), df.na.fill(0, numeric), numeric)
    for column in numeric:
        out = VectorAssembler(inputCols=[column], outputCol=f"v_{column}").transform(out)
    n = train.count()
    for column in texts:
        for drop in (True, False):
            words = terms.preprocess(F.col(column), drop_stopwords=drop)
            counts = terms.term_counts(train, id_col, words, 2)
            fitted = terms.fitted_terms(terms.vocabulary(terms.word_doc_frequency(counts), n), n)
            if fitted:
                out = terms.tfidf_vectors(out, words, fitted, out=f"v_{column}")
                break
        else:
            out = one_hot_vectors(train, out, id_col, column, f"v_{column}")
    return out


def narrowed(fit: Fit, used: tuple[int, ...]) -> Fit:
    """The fit on some columns of a vector."""
    return replace(fit, only=used) if isinstance(fit, trees.TreeFit) else replace(fit, columns=used)


def ablation(
    train: DataFrame,
    test: DataFrame,
    columns: list[str],
    fits: Callable[[int], dict[str, Fit]],
    label: str,
    key: str,
    leave_out: bool,
) -> list[tuple]:
    """Each column alone, or all columns but one; the feature set is named by that column.

    The fits of a kind are made together for all feature sets, on one vector of all columns.
    """
    vectors = [f"v_{c}" for c in columns]
    join = VectorAssembler(inputCols=vectors, outputCol="features")
    parts = [cut_lineage(join.transform(df).select(key, label, vector_to_array("features").alias("_dense"))) for df in (train, test)]
    ends = np.cumsum([0, *(v.size for v in train.select(*vectors).head())]).tolist()
    places = {c: range(a, b) for c, a, b in zip(columns, ends, ends[1:])}
    plan = {}
    for column in columns:
        used = tuple(i for c in columns if (c != column) == leave_out for i in places[c])
        plan |= {(column, name): narrowed(fit, used) for name, fit in fits(len(used)).items()}
    found = joint_scores(plan, *parts, "_dense", label, key, None, 0)
    return [row for (column, name), (_, tested) in found.items() for row in metric_rows(column, name, "test", tested)]
