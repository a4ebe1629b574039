"""Naive Bayes as group-bys: multinomial on term counts, Gaussian on vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.operators.terms import vocabulary


def class_priors(train: DataFrame, label: str) -> tuple[dict, int]:
    """(class → share of rows, number of rows); classes are few."""
    rows = train.groupBy(label).count().collect()
    total = sum(r["count"] for r in rows)
    return {r[label]: r["count"] / total for r in sorted(rows, key=lambda r: r[label])}, total


def multinomial_fit(
    counts: DataFrame, label: str, classes: list, n_docs: int, alpha: float = 1.0, **limits
) -> DataFrame:
    """(term, p_0, p_1 …): smoothed share of each vocabulary term in each class.

    `counts` has (term, tf, label), one row per document and term. They are grouped once;
    the vocabulary (limited to `max_features` rows) comes to the driver with its class sums.
    """
    of_class = [
        F.sum(F.when(F.col(label) == c, F.col("tf")).otherwise(0)).alias(f"n_{i}")
        for i, c in enumerate(classes)
    ]
    frequencies = counts.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("total"), *of_class
    )
    kept = vocabulary(frequencies, n_docs, **limits).collect()
    sums = [[r[f"n_{i}"] for r in kept] for i in range(len(classes))]
    shares = [[(n + alpha) / (sum(column) + alpha * len(kept)) for n in column] for column in sums]
    rows = [(r["term"], *(share[k] for share in shares)) for k, r in enumerate(kept)]
    columns = ", ".join(f"p_{i} double" for i in range(len(classes)))
    return counts.sparkSession.createDataFrame(rows, f"term string, {columns}")


def multinomial_predict(
    docs: DataFrame, counts: DataFrame, table: DataFrame, id_col: str, priors: dict
) -> DataFrame:
    """Class with the highest log score for each row of `docs`; ties go to the first class.

    Only (id, one sum per class) is shuffled. `confidence` is the highest class probability,
    taken after the maximum is subtracted, so long documents do not underflow.
    """
    classes = list(priors)
    logs = [F.log(F.lit(priors[c])) for c in classes]
    sums = (
        counts.join(F.broadcast(table), "term")
        .groupBy(id_col)
        .agg(*[F.sum(F.col("tf") * F.log(F.col(f"p_{i}"))).alias(f"s_{i}") for i in range(len(classes))])
    )
    scored = docs.join(sums, id_col, "left").withColumn(
        "_s", F.array(*[logs[i] + F.coalesce(F.col(f"s_{i}"), F.lit(0.0)) for i in range(len(classes))])
    )
    best = F.array_max("_s")
    label_at = F.get(F.array(*[F.lit(c) for c in classes]), (F.array_position("_s", best) - 1).cast("int"))
    spread = F.aggregate("_s", F.lit(0.0), lambda s, x: s + F.exp(x - F.array_max("_s")))
    return scored.select(*docs.columns, label_at.alias("predicted"), (1.0 / spread).alias("confidence"))


def feature_ratio(table: DataFrame) -> DataFrame:
    """(term, ratio): ln p(term | second class) − ln p(term | first class)."""
    return table.select("term", (F.log("p_1") - F.log("p_0")).alias("ratio"))


def top_and_bottom(ratios: DataFrame, n: int = 20) -> DataFrame:
    top = ratios.orderBy(F.desc("ratio"), "term").limit(n).withColumn("side", F.lit("top"))
    bottom = ratios.orderBy("ratio", "term").limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def gaussian_table(train: DataFrame, label: str, vec_col: str, smoothing: float = 1e-9) -> DataFrame:
    """(label, dim, mean, var): the variance gets a share of the largest one of all columns."""
    long = train.select(F.col(label).alias("label"), F.posexplode(F.col(vec_col).cast("array<double>")).alias("dim", "x"))
    per_class = long.groupBy("label", "dim").agg(F.avg("x").alias("mean"), F.var_pop("x").alias("raw"))
    largest = long.groupBy("dim").agg(F.var_pop("x").alias("v")).agg(F.max("v")).scalar()
    return per_class.select("label", "dim", "mean", (F.col("raw") + smoothing * largest).alias("var"))


def gaussian_predict(df: DataFrame, table: DataFrame, priors: dict, vec_col: str) -> DataFrame:
    """Most likely class of each vector, worked out in its row (the model is classes × dims)."""
    model: dict = {}
    for r in table.orderBy("label", "dim").collect():
        model.setdefault(r["label"], []).append((r["mean"], r["var"]))
    scores = []
    for label, prior in priors.items():
        centre = F.array(*[F.lit(m) for m, _ in model[label]])
        width = F.array(*[F.lit(v) for _, v in model[label]])
        gaps = F.zip_with(F.col(vec_col).cast("array<double>"), centre, lambda x, m: (x - m) * (x - m))
        terms = F.zip_with(gaps, width, lambda g, v: F.log(v * 6.283185307179586) + g / v)
        score = F.log(F.lit(prior)) - 0.5 * F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
        scores.append(F.struct(score.alias("score"), F.lit(label).alias("label")))
    # Of equal scores the smaller label wins, as it stands first.
    best = F.reduce(F.array(*scores), scores[0], lambda a, b: F.when(b["score"] > a["score"], b).otherwise(a))
    return df.withColumn("predicted", best["label"])
