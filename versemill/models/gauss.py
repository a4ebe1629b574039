"""Gaussian naive Bayes for many folds and smoothings from one scan.

Counts, sums and sums of squares by fold, class and feature are added up once; a fit that leaves a
fold out takes that fold's part off the total. Values are centred on the mean of all rows first, so
that squares do not swallow the variance of features far from zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.models.lines import scored


@dataclass(frozen=True)
class GaussFit:
    """`smoothing` times the largest variance of a feature is added to all variances. `columns` are
    those taken (all where none are named)."""

    smoothing: float = 1e-9
    left_out: int = -1
    columns: tuple[int, ...] | None = None


def fit_gauss(df: DataFrame, fits: list[GaussFit], vec_col: str, label: str, key: str | None = None, fold: str | None = None) -> GaussModel:
    """All fits on the rows of `df` (labels 0 and 1). Rows without a label or a vector are not fitted,
    features without a value count as 0; `key` is not used."""
    rows = df.select(
        F.col(vec_col).cast("array<double>").alias("v"), F.col(label).cast("int").alias("y"), (F.col(fold).cast("int") if fold else F.lit(-2)).alias("f")
    )
    long = rows.filter("y IS NOT NULL AND v IS NOT NULL AND f IS NOT NULL").select("y", "f", F.posexplode("v").alias("d", "x"))
    long = long.withColumn("x", F.coalesce(F.nanvl("x", F.lit(0.0)), F.lit(0.0)))
    means = {r["d"]: r["m"] for r in long.groupBy("d").agg(F.avg("x").alias("m")).collect()}
    n = len(means)
    centre = np.array([means[d] for d in range(n)])
    middle = F.get(F.lit(centre.tolist()) if n else F.array(F.lit(0.0)), F.col("d"))
    x = F.col("x") - middle
    parts = long.groupBy("f", "y", "d").agg(F.count("*").alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q")).collect()
    sums: dict[int, np.ndarray] = {}
    for r in parts:
        sums.setdefault(r["f"], np.zeros((2, n, 3)))[r["y"], r["d"]] = r["n"], r["s"], r["q"]
    total = sum(sums.values(), np.zeros((2, n, 3)))
    held = [taken(total - sums.get(fit.left_out, 0.0), fit, 1) for fit in fits]
    return GaussModel(centre, [settled(s, fit.smoothing) for s, fit in zip(held, fits)], fits)


def taken(values: np.ndarray, fit: GaussFit, axis: int) -> np.ndarray:
    return values if fit.columns is None else values.take(fit.columns, axis)


def settled(sums: np.ndarray, smoothing: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log prior by class, mean and variance by class and feature); a class without rows has no prior."""
    rows = sums[:, :1, 0] if sums.shape[1] else np.zeros((2, 1))
    count = np.maximum(rows, 1)
    mean = sums[:, :, 1] / count
    var = np.maximum(sums[:, :, 2] / count - mean**2, 0)
    whole = np.maximum(sums[:, :, 2].sum(0) / count.sum() - (sums[:, :, 1].sum(0) / count.sum()) ** 2, 0)
    var = np.maximum(var + smoothing * whole.max(initial=0.0), np.finfo(float).tiny)
    with np.errstate(divide="ignore"):
        prior = np.log(rows[:, 0] / max(rows.sum(), 1))
    return prior, mean, var


@dataclass
class GaussModel:
    centre: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    fits: list[GaussFit]

    def predict(self, df: DataFrame, vec_col: str, out: str = "scores") -> DataFrame:
        """`df` with the probability of label 1 by each fit, as an array."""
        centre, parts, fits = self.centre, self.parts, self.fits

        def score(x: np.ndarray) -> np.ndarray:
            found = np.zeros((len(x), len(parts)))
            for i, (prior, mean, var) in enumerate(parts):
                away = taken(x - centre, fits[i], 1)
                zero, one = (prior[c] - 0.5 * (np.log(var[c]) + (away - mean[c]) ** 2 / var[c]).sum(1) for c in (0, 1))
                with np.errstate(invalid="ignore"):
                    found[:, i] = 1 / (1 + np.exp(np.clip(np.nan_to_num(zero - one), -500, 500)))
            return found

        return scored(df, vec_col, out, len(centre), score)
