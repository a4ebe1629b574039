import numpy as np
import pytest
from pyspark.sql import functions as F

from versemill.operators import cleaning, comparisons, metrics, ranking, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    """One group and one value hold most of the rows."""
    rng = np.random.default_rng(1)
    values = np.where(rng.random(3000) < 0.5, 7.0, rng.normal(0, 50, 3000)).round(2)
    labels = (rng.random(3000) < 0.1).astype(int)
    rows = [(i * 3, float(v), int(y)) for i, (v, y) in enumerate(zip(values, labels))]
    return spark.createDataFrame(rows, "id bigint, x double, y int").cache()


def test_row_numbers(skewed):
    got = [r["rn"] for r in ranking.number_by_id(skewed, "id").orderBy("id").collect()]
    assert got == list(range(1, 3001))


def test_running_totals(skewed):
    bucketed = ranking.value_buckets(skewed, "id")
    out = ranking.running_totals(bucketed, ["y"], ["id"], {"before": F.col("x")}).orderBy("id").toPandas()
    want = out.groupby("y")["x"].cumsum() - out["x"]
    assert np.allclose(out["before"], want)


def test_exact_percentiles(skewed):
    shares = [0.05, 0.5, 0.77, 0.95]
    got = ranking.exact_percentiles(skewed, {"x": F.col("x"), "id": F.col("id")}, shares)
    frame = skewed.toPandas()
    for name in ("x", "id"):
        assert got[name] == pytest.approx(list(np.percentile(frame[name], [100 * s for s in shares])))


def test_numbers_of_ids(skewed):
    got = [r["rn"] for r in ranking.number_by_id(skewed, "id").orderBy("id").collect()]
    assert got == list(range(1, 3001))


def test_numbers_along_texts(spark):
    values = [f"é{i % 7}{i:04d}" for i in range(500)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    got = {r["v"]: r["rn"] for r in ranking.number_sorted(df, "v").collect()}
    assert got == {v: i for i, v in enumerate([*sorted(values[:-1]), None], 1)}


@pytest.mark.parametrize("n", [0, 1, 100, 2999, 3000, 5000])
def test_sample_size(skewed, n):
    got = sampling.sample_n(skewed, "id", n, seed=1)
    assert got.count() == got.select("id").distinct().count() == min(n, 3000)


def test_split_laws(skewed):
    rows = sampling.split_stratified(skewed, "id", "y").toPandas()
    assert sorted(rows["id"]) == sorted(skewed.toPandas()["id"])
    for _, part in rows.groupby("y"):
        assert abs((part["part"] == "test").sum() - 0.2 * len(part)) <= 0.5


def test_split_does_not_depend_on_partitions(skewed):
    first = sampling.split_stratified(skewed, "id", "y").toPandas().set_index("id")["part"]
    again = sampling.split_stratified(skewed.repartition(17), "id", "y").toPandas().set_index("id")["part"]
    assert first.sort_index().equals(again.sort_index())


def test_folds_and_balance(skewed):
    folds = sampling.kfold_stratified(skewed, "id", "y", 5).groupBy("y", "fold").count().toPandas()
    assert (folds.groupby("y")["count"].max() - folds.groupby("y")["count"].min() <= 1).all()
    sizes = {r["y"]: r["count"] for r in sampling.undersample(skewed, "id", "y").groupBy("y").count().collect()}
    assert sizes[0] == sizes[1] == skewed.filter("y = 1").count()


def test_auc_with_ties(skewed):
    frame = skewed.toPandas()
    pos, neg = frame[frame.y == 1]["x"].to_numpy(), frame[frame.y == 0]["x"].to_numpy()
    want = (np.sign(pos[:, None] - neg[None, :]) + 1).mean() / 2
    assert metrics.roc_auc(skewed, "x", "y").head()["auc"] == pytest.approx(want)


def test_single_class(spark):
    rows = spark.createDataFrame([(0, 0, 0.3)] * 4, "y int, p int, s double")
    assert metrics.binary_metrics(rows, "y", "p").head().asDict() == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}
    assert metrics.roc_auc(rows, "s", "y").head()["auc"] == 0.0
    assert metrics.best_threshold(metrics.threshold_sweep(rows, "s", "y")).head()["threshold"] == 0.5


def test_pack_batches_limits(spark):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 60, 500)
    rows = spark.createDataFrame([(i, int(b)) for i, b in enumerate(sizes)], "id bigint, bytes bigint")
    packed = cleaning.pack_batches(rows, "id", "bytes", 20, 300).orderBy("id").toPandas()
    assert (packed["batch"].diff().dropna().isin([0, 1])).all() and packed["batch"].iloc[0] == 1
    groups = packed.groupby("batch")["bytes"]
    assert groups.count().max() <= 20 and groups.sum().max() < 300 + 60


def test_ids_listed_beyond_the_rows_do_not_matter(spark):
    rows = spark.range(5)
    drop = spark.createDataFrame([(1,), (9,)], "id bigint")
    kept = cleaning.drop_listed_rows(rows, drop, "id").orderBy("id").collect()
    assert [(r["id"], r["row_id"]) for r in kept] == [(0, 0), (2, 1), (3, 2), (4, 3)]


def test_chi2_tail():
    assert comparisons.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert comparisons.chi2_tail(0.0, 3) == 1.0
    assert comparisons.chi2_tail(18.307038053275146, 10) == pytest.approx(0.05)


def test_holm_rejects_in_order(spark):
    rows = [(d, m, e) for d in range(30) for m, e in (("a", 0.1 + d / 1000), ("b", 0.2 + d / 500), ("c", 0.2 + (d % 2) / 100 + d / 500))]
    out = comparisons.wilcoxon_holm(spark.createDataFrame(rows, "d int, m string, e double"), "d", "m", "e").orderBy("holm_order").collect()
    assert [r["holm_order"] for r in out] == [1, 2, 3]
    assert [r["p_value"] for r in out] == sorted(r["p_value"] for r in out)
    assert out[0]["rejected"] and out[0]["statistic"] == 0.0


def test_rows_without_a_class_stay(spark):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(60)], "id bigint, y int")
    assert sampling.split_stratified(rows, "id", "y").count() == 60
    folds = sampling.kfold_stratified(rows, "id", "y", 5)
    assert folds.count() == 60 and folds.filter("fold IS NULL").count() == 0
