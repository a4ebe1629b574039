"""Least squares and what each feature adds to a linear prediction."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def linear_regression(df: DataFrame, features: list[str], label: str):
    """Fitted model and the rows with `prediction`; one pass for the normal equations."""
    rows = VectorAssembler(inputCols=features, outputCol="_x").transform(df)
    model = LinearRegression(featuresCol="_x", labelCol=label, solver="normal").fit(rows)
    return model, model.transform(rows).drop("_x")


def linear_attribution(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(feature, attribution): mean |w · (x − mean x)| of each feature."""
    means = df.agg(*[F.avg(c).alias(c) for c in weights]).head()
    parts = df.agg(*[F.avg(F.abs(F.lit(w) * (F.col(c) - F.lit(means[c])))).alias(c) for c, w in weights.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("attribution")) for c in weights]))
    return parts.select(rows.alias("r")).select("r.*")
