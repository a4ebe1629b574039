"""Linear and Gaussian fits made together: optimal, alone as in company, folds, columns, odd rows."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from versemill.models import gauss, lines


def rows(spark, n=300, width=5, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    y = (x[:, 0] - 0.5 * x[:, 2] + rng.normal(size=n) > 0.3).astype(int)
    data = [(i, x[i].tolist(), int(y[i]), i % 4) for i in range(n)]
    return spark.createDataFrame(data, "id long, v array<double>, y int, fold int"), x, y


FITS = [
    lines.LineFit("logistic", 1.0),
    lines.LineFit("logistic", 0.1, columns=(0, 3)),
    lines.LineFit("logistic", 1.0, left_out=2),
    lines.LineFit("hinge", 1.0),
]


def objective(fit, x, y, point):
    value, slope = lines.losses(fit, lines.WIDTHS[-1] if fit.loss == "hinge" else 1.0, x @ point[:-1] + point[-1], y)
    return value.sum() + point[:-1] @ point[:-1] / (2 * fit.c), np.append(x.T @ slope + point[:-1] / fit.c, slope.sum())


def test_slopes_vanish_whatever_the_partitions(spark):
    frame, x, y = rows(spark)
    model = lines.fit_lines(frame.repartition(5), FITS, "v", "y", fold="fold")
    for i, fit in enumerate(FITS):
        kept = np.arange(len(x)) % 4 != fit.left_out
        used = np.append(lines.used_columns(fit, 5), True)
        _, slope = objective(fit, x[kept], y[kept], model.weights[i])
        assert np.abs(slope[used]).max() <= (1e-5 if fit.loss == "hinge" else 1e-6) * len(x) * 1.001
        assert (model.weights[i][~used] == 0).all()
    alone = lines.fit_lines(frame.coalesce(1), FITS[2:3], "v", "y", fold="fold")
    assert np.allclose(alone.weights[0], model.weights[2], atol=1e-4)


def test_no_small_change_is_better(spark):
    frame, x, y = rows(spark, 200)
    fit = lines.LineFit("hinge", 0.5)
    point = lines.fit_lines(frame, [fit], "v", "y").weights[0]
    plain = lambda p: np.maximum(0, 1 - (2 * y - 1) * (x @ p[:-1] + p[-1])).sum() + p[:-1] @ p[:-1] / (2 * fit.c)
    rng = np.random.default_rng(0)
    here = plain(point)
    for size in (1e-3, 1e-2, 1e-1, 1.0):
        for _ in range(50):
            assert plain(point + size * rng.normal(size=6)) >= here - len(x) * lines.WIDTHS[-1] / 2


def test_slope_is_that_of_the_loss():
    margin, y = np.linspace(-3, 3, 601) + 1e-4, np.tile([0, 1], 301)[:601]
    for fit in (lines.LineFit("logistic"), lines.LineFit("hinge")):
        for width in (0.5, 0.05):
            up, down = (lines.losses(fit, width, margin + e, y)[0] for e in (1e-6, -1e-6))
            assert np.allclose((up - down) / 2e-6, lines.losses(fit, width, margin, y)[1], atol=1e-3)


def test_gauss_equals_the_fit_on_the_rows_of_other_folds(spark):
    frame, x, y = rows(spark)
    for offset in (0.0, 1e6):
        moved = x + offset
        fits = [gauss.GaussFit(1e-9), gauss.GaussFit(1e-2, left_out=1)]
        shifted = frame.withColumn("v", F.transform("v", lambda e: e + offset))
        got = gauss.fit_gauss(shifted, fits, "v", "y", fold="fold").predict(shifted, "v").orderBy("id").collect()
        for i, fit in enumerate(fits):
            kept = np.arange(len(x)) % 4 != fit.left_out
            var = fit.smoothing * moved[kept].var(0).max()
            logs = []
            for c in (0, 1):
                part = moved[kept & (y == c)]
                v = part.var(0) + var
                logs.append(np.log(len(part) / kept.sum()) - 0.5 * (np.log(v) + (moved - part.mean(0)) ** 2 / v).sum(1))
            want = 1 / (1 + np.exp(logs[0] - logs[1]))
            assert np.allclose([r["scores"][i] for r in got], want, atol=1e-6)


@pytest.mark.parametrize("fit_all, fit", [(lines.fit_lines, lines.LineFit()), (gauss.fit_gauss, gauss.GaussFit())])
def test_odd_rows(spark, fit_all, fit):
    schema = "id long, v array<double>, y int, scores int"
    odd = [(1, [1.0, None], 1, 7), (2, [float("nan"), 2.0], 0, 7), (3, None, 1, 7), (4, [1.0, 1.0], None, 7), (4, [1.0, 1.0], None, 7)]
    model = fit_all(spark.createDataFrame(odd, schema), [fit], "v", "y")
    found = model.predict(spark.createDataFrame(odd, schema), "v", "p").collect()
    assert len(found) == 5 and all(0 <= r["p"][0] <= 1 and r["scores"] == 7 for r in found)
    empty = fit_all(spark.createDataFrame([], schema), [fit, replace(fit, left_out=0)], "v", "y")
    assert empty.predict(spark.createDataFrame([], schema), "v", "p").count() == 0
    same = fit_all(spark.createDataFrame([(i, [1.0], 1, 7) for i in range(3)], schema), [fit], "v", "y")
    assert all(r["p"][0] > 0.5 for r in same.predict(spark.createDataFrame([(1, [1.0], 1, 7)], schema), "v", "p").collect())
