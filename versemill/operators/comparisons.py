"""Comparison of algorithms over data sets: ranks, Friedman, Wilcoxon with Holm.

Input is long: (dataset, model, error). A data set has one row per model, so ranks within a
data set are small windows; sums over data sets are ordinary aggregates.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from versemill.operators.ranking import running_totals, value_buckets


def rank_min(df: DataFrame, dataset: str, error: str) -> DataFrame:
    """Rank inside each data set, lowest error first; ties share the lowest rank."""
    order = Window.partitionBy(dataset).orderBy(error)
    return df.withColumn("rank", F.rank().over(order).cast("bigint"))


def rank_summary(ranked: DataFrame, model: str) -> DataFrame:
    """(row, model, value): sum and mean of the ranks of each model."""
    sums = ranked.groupBy(model).agg(
        F.round(F.sum("rank").cast("double"), 3).alias("sum"), F.round(F.avg("rank"), 3).alias("mean")
    )
    rows = F.array(
        F.struct(F.lit("Sum Ranks").alias("row"), F.col("sum").alias("value")),
        F.struct(F.lit("Average Ranks").alias("row"), F.col("mean").alias("value")),
    )
    return sums.select(model, F.explode(rows).alias("r")).select("r.row", model, "r.value")


def chi2_tail(x: float, degrees: int) -> float:
    """Upper tail of the chi-squared distribution (the regularised gamma functions).

    Below the mean the series of the lower tail is summed until it stands still; above it the
    continued fraction of the upper tail converges in a few steps (Lentz's method).
    """
    a, z = degrees / 2, x / 2
    if z <= 0:
        return 1.0
    front = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1 / a
        k = 0
        while term > total * 1e-17:
            k += 1
            term *= z / (a + k)
            total += term
        return max(0.0, 1 - total * front)
    tiny = 1e-300
    b = z + 1 - a
    c, d = 1 / tiny, 1 / b
    h, step, k = d, 2.0, 0
    while abs(step - 1) > 1e-16:
        k += 1
        part = -k * (k - a)
        b += 2
        d = 1 / (part * d + b or tiny)
        c = b + part / c or tiny
        step = d * c
        h *= step
    return front * h


def friedman(df: DataFrame, dataset: str, model: str, value: str) -> DataFrame:
    """Friedman chi-squared with tie correction, and its p value: one row.

    Only data sets with all models are ranked; the others are counted in `n_incomplete`.
    """
    sizes = df.groupBy(F.col(dataset).alias("_d")).agg(F.countDistinct(model).alias("_k"))
    seen = df.agg(F.countDistinct(model).alias("k"), F.countDistinct(dataset).alias("n")).head()
    whole = sizes.filter(F.col("_k") == (seen["k"] or 0))
    df = df.join(whole, F.col(dataset) == F.col("_d"), "left_semi")
    order = Window.partitionBy(dataset).orderBy(value)
    ties = Window.partitionBy(dataset, value)
    same = F.count("*").over(ties)
    ranked = df.select(
        dataset, model, (F.rank().over(order) + (same - 1) / 2).alias("rank"), (same * same - 1).alias("tie")
    )
    per_model = ranked.groupBy(model).agg(
        F.sum("rank").alias("sum"), F.sum("tie").alias("tie"), F.count("*").alias("n")
    )
    # Each member of a group of t ties adds t² − 1, hence the group t³ − t.
    row = per_model.agg(
        F.count("*").alias("k"), F.max("n").alias("n"),
        F.sum(F.col("sum") * F.col("sum")).alias("squares"), F.sum("tie").alias("ties"),
    ).head()
    k, n = row["k"] or 0, row["n"] or 0
    # With one model, or with ties everywhere, there is nothing to tell apart.
    correction = 1 - row["ties"] / (n * k * (k * k - 1)) if k > 1 else 0.0
    statistic = (12 / (n * k * (k + 1)) * row["squares"] - 3 * n * (k + 1)) / correction if correction else 0.0
    return df.sparkSession.createDataFrame(
        [(n, seen["n"] - n, k, statistic, chi2_tail(statistic, max(1, k - 1)))],
        "n_datasets bigint, n_incomplete bigint, n_models bigint, statistic double, p_value double",
    )


def signed_ranks(df: DataFrame, dataset: str, model: str, value: str) -> DataFrame:
    """(first, second, n, plus, minus, ties): rank sums of the differences of two models.

    The values of one data set (one per model) stand in one row, from which the pairs of
    models are read. Equal absolute differences of a pair are counted before they are ranked,
    and the ranks are running totals over buckets, not a sort of all data sets in one task.
    """
    held = df.groupBy(dataset).agg(
        F.sort_array(F.collect_list(F.struct(F.col(model).alias("m"), F.col(value).alias("v")))).alias("r")
    )
    pairs = held.select(dataset, F.posexplode("r").alias("i", "a"), "r").select(
        dataset, "a", F.explode(F.slice("r", F.col("i") + 2, F.size("r"))).alias("b")
    )
    gaps = pairs.select(
        F.col("a.m").alias("first"), F.col("b.m").alias("second"), F.round(F.col("a.v") - F.col("b.v"), 9).alias("gap")
    )
    every = gaps.select(F.col("first").alias("_f"), F.col("second").alias("_s")).distinct()
    counted = gaps.filter("gap <> 0").groupBy("first", "second", F.abs("gap").alias("size")).agg(
        F.count("*").alias("n"), F.sum((F.col("gap") > 0).cast("bigint")).alias("n_plus")
    )
    ranked = running_totals(value_buckets(counted, "size"), ["first", "second"], ["size"], {"below": F.col("n")})
    rank = F.col("below") + (F.col("n") + 1) / 2
    n = F.col("n")
    sums = ranked.groupBy("first", "second").agg(
        F.sum("n").alias("n"),
        F.sum(rank * F.col("n_plus")).alias("plus"),
        F.sum(rank * (n - F.col("n_plus"))).alias("minus"),
        F.sum(n * n * n - n).alias("ties"),
    )
    # Two models that never differ are a pair as well, with nothing to rank.
    joined = every.join(sums, (F.col("first") == F.col("_f")) & (F.col("second") == F.col("_s")), "left")
    return joined.select(
        F.col("_f").alias("first"), F.col("_s").alias("second"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "plus", "minus", "ties")]
    )


def wilcoxon_holm(df: DataFrame, dataset: str, model: str, value: str, alpha: float = 0.05) -> DataFrame:
    """Wilcoxon statistic of each pair of models, normal p value, Holm order and decision."""
    rows = signed_ranks(df, dataset, model, value).collect()  # one row per pair of models
    tested = []
    for r in rows:
        n, statistic = r["n"], min(r["plus"], r["minus"])
        spread = math.sqrt((n * (n + 1) * (2 * n + 1) - r["ties"] / 2) / 24)
        z = (statistic - n * (n + 1) / 4) / spread if spread else 0.0
        tested.append((-round(abs(z), 9), r["first"], r["second"], n, float(statistic), math.erfc(abs(z) / math.sqrt(2))))
    out, rejecting = [], True
    for place, (_, first, second, n, statistic, p) in enumerate(sorted(tested)):
        rejecting = rejecting and p <= alpha / (len(tested) - place)
        out.append((first, second, n, statistic, p, place + 1, rejecting))
    return df.sparkSession.createDataFrame(
        out,
        "first string, second string, n bigint, statistic double, p_value double, holm_order int, rejected boolean",
    )
