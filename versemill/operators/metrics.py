"""Evaluation of predictions; each metric is one pass over (actual, predicted) rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versemill.functions.scalars import ratio
from versemill.operators.ranking import running_totals, value_buckets


def _count(condition: Column) -> Column:
    return F.sum(condition.cast("int")).cast("bigint")


def label_distribution(df: DataFrame, label: str, *groups: str) -> DataFrame:
    return df.groupBy(*groups, label).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels=(0, 1)) -> DataFrame:
    """(actual, predicted, n) for every pair of labels, also those that never occur."""
    pairs = [(a, p) for a in labels for p in labels]
    cells = df.agg(
        *[
            F.count(F.when((F.col(actual) == a) & (F.col(predicted) == p), 1)).alias(f"n_{a}_{p}")
            for a, p in pairs
        ]
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"n_{a}_{p}").alias("n"))
                for a, p in pairs
            ]
        )
    )
    return cells.select(rows.alias("r")).select("r.*")


def confusion_percent(matrix: DataFrame) -> DataFrame:
    row_total = F.sum("n").over(Window.partitionBy("actual"))
    return matrix.select("actual", "predicted", (ratio(F.col("n"), row_total) * 100).alias("percent"))


def binary_counts(df: DataFrame, actual: str, predicted: str, *groups: str) -> DataFrame:
    hit, said = F.col(actual) == 1, F.col(predicted) == 1
    return df.groupBy(*groups).agg(
        _count(hit & said).alias("tp"),
        _count(~hit & said).alias("fp"),
        _count(hit & ~said).alias("fn"),
        _count(~hit & ~said).alias("tn"),
    )


def rates(counts: DataFrame, *groups: str) -> DataFrame:
    """Accuracy, precision, recall and F1 from tp, fp, fn, tn; 0 on a zero denominator."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *groups,
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def binary_metrics(df: DataFrame, actual: str, predicted: str, *groups: str) -> DataFrame:
    return rates(binary_counts(df, actual, predicted, *groups), *groups)


def long_metrics(wide: DataFrame, names: list[str], *keys: str) -> DataFrame:
    return wide.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
        ).alias("m"),
    ).select(*keys, "m.metric", "m.value")


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted averages."""
    pairs = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    # Each pair counts for its actual class and for its predicted class.
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("said"), F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("said"), F.lit(0).cast("bigint").alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    per_class = (
        sides.groupBy("c")
        .agg(F.sum("support").alias("support"), F.sum("said").alias("said"), F.sum("tp").alias("tp"))
        .select(
            F.col("c").cast("string").alias("class"),
            ratio(F.col("tp"), F.col("said")).alias("precision"),
            ratio(F.col("tp"), F.col("support")).alias("recall"),
            ratio(2 * F.col("tp"), F.col("said") + F.col("support")).alias("f1"),
            "support",
        )
    )
    # One rollup gives the classes and, in its total row, both averages over them.
    names = ["precision", "recall", "f1"]
    rolled = per_class.rollup("class").agg(
        *[F.avg(n).alias(n) for n in names],
        *[ratio(F.sum(F.col(n) * F.col("support")), F.sum("support")).alias(f"w_{n}") for n in names],
        F.sum("support").alias("support"),
        F.grouping("class").alias("total"),
    )
    plain = F.struct(F.coalesce(F.col("class"), F.lit("macro avg")).alias("class"), *names, "support")
    weighted = F.struct(F.lit("weighted avg").alias("class"), *[F.col(f"w_{n}").alias(n) for n in names], "support")
    rows = F.when(F.col("total") == 1, F.array(plain, weighted)).otherwise(F.array(plain))
    return rolled.select(F.explode(rows).alias("r")).select("r.*")


def roc_auc(df: DataFrame, score: str, actual: str) -> DataFrame:
    """Area under the ROC curve, a tie counting one half.

    Rows are first counted per distinct score; the counts are then summed in score order.
    """
    per_score = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        _count(F.col(actual) == 1).alias("pos"), _count(F.col(actual) != 1).alias("neg")
    )
    below = running_totals(value_buckets(per_score, "score"), [], ["score"], {"below": F.col("neg")})
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0))
    return below.agg(ratio(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def thresholds() -> list[float]:
    return [float(t) for t in np.arange(0.1, 0.9, 0.05)]


def threshold_sweep(df: DataFrame, score: str, actual: str) -> DataFrame:
    """F1 at each threshold. A row is counted once, by the number of thresholds it passes."""
    grid = thresholds()
    passed = sum(((F.col(score) >= t).cast("int") for t in grid[1:]), (F.col(score) >= grid[0]).cast("int"))
    counts = df.groupBy(passed.alias("passed")).agg(
        _count(F.col(actual) == 1).alias("pos"), _count(F.col(actual) != 1).alias("neg")
    )
    steps = F.explode(
        F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(t).alias("threshold")) for i, t in enumerate(grid)])
    )
    at = counts.select("*", steps.alias("g")).select("passed", "pos", "neg", "g.*")
    said = F.col("passed") >= F.col("step")
    sums = at.groupBy("threshold").agg(
        F.sum(F.when(said, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(said, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~said, F.col("pos")).otherwise(0)).alias("fn"),
    )
    f1 = ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return sums.select("threshold", f1.alias("f1"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first threshold with the highest F1; 0.5 when all are 0."""
    best = sweep.agg(F.max(F.struct("f1", -F.col("threshold"))).alias("b")).select(
        F.col("b.f1").alias("f1"), (-F.col("b.col2")).alias("threshold")
    )
    return best.select(F.when(F.col("f1") > 0, F.col("threshold")).otherwise(F.lit(0.5)).alias("threshold"), "f1")


def apply_threshold(score: Column, threshold: Column | float) -> Column:
    return F.when(score >= threshold, 1).otherwise(0)


def cv_summary(folds: DataFrame, metric: str, value: str, *groups: str) -> DataFrame:
    """Mean and population standard deviation over folds, four decimals."""
    return folds.groupBy(*groups, metric).agg(
        F.round(F.avg(value), 4).alias("mean"), F.round(F.stddev_pop(value), 4).alias("std")
    )


def leaderboard(runs: DataFrame, group: str, model: str, score: str) -> DataFrame:
    """Position of each model within its group, best score first, ties by name."""
    order = Window.partitionBy(group).orderBy(F.desc(score), model)
    return runs.select(group, model, score, F.row_number().over(order).cast("bigint").alias("position"))


def best_per_group(runs: DataFrame, group: str, model: str, score: str) -> DataFrame:
    """The whole row of the best model of each group, ties by name."""
    rest = [c for c in runs.columns if c not in (group, model, score)]
    # Of the models that share the best score, the first name.
    top = runs.groupBy(group, score).agg(F.min_by(F.struct(model, *rest), F.col(model)).alias("row"))
    best = top.groupBy(group).agg(F.max_by(F.struct("row", score), F.col(score)).alias("b"))
    return best.select(group, F.col(f"b.row.{model}").alias(model), F.col(f"b.{score}").alias(score), *[F.col(f"b.row.{c}").alias(c) for c in rest])


def best_overall(runs: DataFrame, score: str, *ties: str) -> DataFrame:
    return runs.orderBy(F.desc(score), *ties).limit(1)


def error_listing(
    df: DataFrame, texts: DataFrame, id_col: str, actual: str, predicted: str, probability: str, text: str, n: int = 10
) -> DataFrame:
    """The first n wrong rows, long texts cut to 100 characters, with the confidence.

    The n rows are found first; only then are their texts looked up.
    """
    wrong = df.filter(F.col(actual) != F.col(predicted)).orderBy(id_col).limit(n)
    shown = F.when(F.length(text) > 100, F.concat(F.substring(text, 1, 100), F.lit("..."))).otherwise(F.col(text))
    sure = F.greatest(F.col(probability), 1 - F.col(probability))
    held = texts.select(id_col, text).join(F.broadcast(wrong), id_col)
    return held.select(id_col, actual, predicted, shown.alias("shown"), F.round(sure, 3).alias("confidence"))


def pseudo_label_vote(label: Column, first: Column, second: Column) -> Column:
    """1 where the given label is 1 or both models say 1 (ties and majority give the same)."""
    return F.when((label == 1) | ((first == 1) & (second == 1)), 1).otherwise(0)


def label_change_report(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("n"), _count(F.col(old) != F.col(new)).alias("changed")
    ).select("n", "changed", F.round(ratio(F.col("changed"), F.col("n")) * 100, 6).alias("percent"))


def log_loss(df: DataFrame, actual: str, probability: str, epsilon: float = 1e-15) -> DataFrame:
    p = F.greatest(F.least(F.col(probability), F.lit(1 - epsilon)), F.lit(epsilon))
    y = F.col(actual)
    return df.agg((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def regression_error(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    gap = F.col(predicted) - F.col(actual)
    return df.agg(F.avg(gap * gap).alias("mse")).select("mse", F.sqrt("mse").alias("rmse"))


def token_cost(df: DataFrame, tokens: str, rate_per_thousand: float) -> DataFrame:
    total = F.sum(tokens).cast("bigint")
    return df.agg(total.alias("tokens")).withColumn("cost", F.col("tokens") / 1000 * rate_per_thousand)
