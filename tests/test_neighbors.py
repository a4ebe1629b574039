import numpy as np
import pytest
from pyspark.sql import functions as F

from versemill.operators import clusters, joins, nearest, neighbors


@pytest.fixture(scope="module")
def points():
    """Clumps of very different size, with copies."""
    rng = np.random.default_rng(3)
    clumps = [rng.normal(c, 0.3, (n, 4)) for c, n in ((0, 200), (5, 60), (-8, 30))]
    out = np.vstack([*clumps, clumps[0][:20]])
    return out.astype(np.float32).astype(float)


@pytest.fixture(scope="module")
def frame(spark, points):
    rows = [(i, [float(x) for x in p], int(p[0] > 2) + 2 * int(p[0] < -4)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>, c int").cache()


def brute(points, k):
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(distance, np.inf)
    return np.argsort(distance, axis=1, kind="stable")[:, :k]


@pytest.mark.parametrize("block", [16, 64, 1000])
def test_nearest_is_exact(frame, points, block):
    got = neighbors.nearest(frame, "id", "vec", 5, block=block).toPandas()
    table = got.sort_values(["id", "place"])["neighbour"].to_numpy().reshape(-1, 5)
    assert (table == brute(points, 5)).all()


def test_smote_balances_on_segments(frame, points):
    labelled = frame.withColumn("y", (F.col("c") == 2).cast("int"))
    made = neighbors.smote(labelled, "id", "y", "vec", k=5).collect()
    minority = points[[r["id"] for r in labelled.filter("y = 1").collect()]]
    assert len(made) == len(points) - 2 * len(minority)
    low, high = minority.min(axis=0) - 1e-9, minority.max(axis=0) + 1e-9
    vectors = np.array([r["vec"] for r in made])
    assert ((vectors >= low) & (vectors <= high)).all() and {r["y"] for r in made} == {1}


def test_smote_of_balanced_classes_is_empty(spark):
    rows = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(6)], "id bigint, vec array<double>, y int")
    assert neighbors.smote(rows, "id", "y", "vec").count() == 0


def test_distances_by_products_keep_small_gaps():
    """Far from zero, with copies and with rows that are all but equal."""
    rng = np.random.default_rng(4)
    left = rng.normal(1000, 1, (300, 8))
    right = np.vstack([left[:50], left[50:90] + 1e-7, rng.normal(1000, 1, (200, 8))])
    got = np.vstack([d for _, d in neighbors._product_distances(left, right)])
    want = np.sqrt(((left[:, None] - right[None]) ** 2).sum(axis=2))
    assert np.allclose(got, want, rtol=1e-7, atol=1e-12) and (np.diag(got)[:50] == 0).all()


def test_rows_of_a_silhouette_are_moved_as_often_as_there_are_blocks(spark, monkeypatch):
    """Two blocks at most, as the largest blocks hold: each row meets each block once, in three pairs."""
    monkeypatch.setattr(nearest, "MOST_BLOCKS", 2)
    rows = spark.createDataFrame([(i, [float(i % 7), float(i % 3)], i % 2) for i in range(400)], "id bigint, vec array<double>, c int")
    seen = neighbors.cluster_distances(rows, "id", "vec", "c", block=10)
    assert "FlatMapGroupsInArrow" in seen._jdf.queryExecution().toString() and seen.count() == 800
    total = seen.agg(F.sum("total")).head()[0]
    p = np.array([[i % 7, i % 3] for i in range(400)], float)
    assert np.isclose(total, np.sqrt(((p[:, None] - p[None]) ** 2).sum(axis=2)).sum())


def test_silhouettes(frame, points):
    labels = np.array([r["c"] for r in frame.orderBy("id").collect()])
    for power, got in ((1, neighbors.silhouette(frame, "id", "vec", "c", block=50)), (2, clusters.silhouette_squared(frame, "id", "vec", "c"))):
        distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2)) ** power
        scores = []
        for i in range(len(points)):
            own = labels == labels[i]
            a = distance[i][own].sum() / (own.sum() - 1)
            b = min(distance[i][labels == c].mean() for c in set(labels) - {labels[i]})
            scores.append((b - a) / max(a, b))
        assert got.head()["silhouette"] == pytest.approx(np.mean(scores))


def test_cosine_of_a_zero_vector(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [2.0, 0.0]), (4, [1.0, 0.0])], "id int, v array<double>")
    top = joins.cosine_topn(rows, "id", "v", 1, 3).collect()
    assert [(r["id"], r["similarity"]) for r in top] == [(3, 1.0), (4, 1.0), (2, 0.0)]
    with pytest.raises(ValueError):
        joins.cosine_topn(rows, "id", "v", 99, 3)


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e8])
def test_cluster_quality_far_from_zero(spark, offset):
    rng = np.random.default_rng(5)
    label = np.arange(300) % 3
    x = (label[:, None] * np.array([1.0, 2.0]) + rng.normal(size=(300, 2))).round(3) + offset
    frame = spark.createDataFrame([(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(label, x))], "id long, c int, v array<double>")
    near = x - x.mean(0)
    means = [near[label == c].mean(0) for c in range(3)]
    within = sum(((near[label == c] - means[c]) ** 2).sum() for c in range(3))
    between = sum(100 * (m**2).sum() for m in means)
    assert clusters.quality(frame, "c", "v").head()["calinski_harabasz"] == pytest.approx(between / 2 / (within / 297), rel=1e-5)
    far = ((near[:, None] - near[None]) ** 2).sum(2)
    mean = np.stack([far[:, label == c].sum(1) / 100 for c in range(3)], 1)
    a = mean[np.arange(300), label] * 100 / 99
    b = np.where(np.arange(3) == label[:, None], np.inf, mean).min(1)
    got = clusters.silhouette_squared(frame, "id", "v", "c").head()["silhouette"]
    assert got == pytest.approx(((b - a) / np.maximum(a, b)).mean(), abs=1e-5)
