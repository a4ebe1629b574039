import numpy as np
import pytest
from pyspark.sql import functions as F

from versemill.models import classifiers as ml
from versemill.models import nets


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    sizes, x, y = [4, 5, 3, 2], rng.normal(size=(9, 4)), rng.integers(0, 2, 9)
    point = nets.first_weights(sizes, 7)
    total = nets.loss_and_slopes(point, sizes, x, y)
    step = 1e-6 * np.eye(len(point))
    near = [(nets.loss_and_slopes(point + s, sizes, x, y)[0] - nets.loss_and_slopes(point - s, sizes, x, y)[0]) / 2e-6 for s in step]
    assert np.allclose(total[1:], near, atol=1e-5)


@pytest.fixture(scope="module")
def corners(spark):
    """Label 1 where the signs of two numbers differ: no line tells them apart."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 2))
    rows = [(int(i), [float(v) for v in r], int(r[0] * r[1] < 0)) for i, r in enumerate(x)]
    return ml.with_vector(spark.createDataFrame(rows, "id int, embedding array<double>, label int").repartition(5), "embedding").cache()


def test_a_net_learns_what_no_line_can(corners):
    train, valid = corners.filter("id % 4 <> 0"), corners.filter("id % 4 = 0")
    model = ml.train_mlp(train, valid, [16, 8], 2, steps=5, iterations=40)
    assert ml.score(model.transform(valid))["f1"] > 0.9


def test_nets_are_fitted_together(corners, monkeypatch):
    """One job a step for all nets, and the same nets as one by one."""
    asked = []
    plain = nets.sums_at
    monkeypatch.setattr(nets, "sums_at", lambda blocks, sizes, points, n: asked.append(set(points)) or plain(blocks, sizes, points, n))
    both = nets.fit_nets(corners, corners, {"a": [4], "b": [6, 3]}, 2, steps=2, iterations=3)
    assert sum(names == {"a", "b"} for names in asked) > 2 and len(asked) < 20
    alone = ml.train_mlp(corners, corners, [6, 3], 2, steps=2, iterations=3)
    assert np.allclose(both["b"].weights, alone.weights, atol=1e-6)


def test_rows_without_a_label_are_not_fitted_and_no_vector_is_zeros(corners):
    odd = corners.withColumn("label", F.when(F.col("id") < 600, F.col("label")))
    model = ml.train_mlp(odd, corners, [4], 2, steps=1, iterations=3)
    same = ml.train_mlp(corners.filter("id < 600"), corners, [4], 2, steps=1, iterations=3)
    assert np.allclose(model.weights, same.weights, atol=1e-6)
    none = corners.withColumn("features", F.when(F.col("id") > 0, F.col("features")))
    assert model.transform(none).filter("prediction IS NULL").isEmpty()
