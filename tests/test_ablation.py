import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from versemill.models import classifiers as ml
from versemill.models import experiments, gauss, lines, trees

QUICK = ml.Settings(iterations=50, tree_depth=4, trees=6, forest_depth=5, rounds=4, boost_depth=3)


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] + x[:, 3] + 0.5 * rng.normal(size=400) > 0).astype(int)
    rows = [(i, int(b), *([float(v) for v in r[a:z]] for a, z in ((0, 1), (1, 3), (3, 5)))) for i, (r, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, label int, a array<double>, b array<double>, c array<double>")
    df = df.select("id", "label", *[array_to_vector(n).alias(f"v_{n}") for n in "abc"], F.concat("b", "c").alias("bc")).cache()
    return df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")


@pytest.mark.parametrize("leave_out", [False, True])
def test_all_feature_sets_are_fitted_together(parts, monkeypatch, leave_out):
    made = []
    together = {kind: (lambda *a, f=f: made.append(len(a[1])) or f(*a)) for kind, f in experiments.TOGETHER.items()}
    monkeypatch.setattr(experiments, "TOGETHER", together)
    rows = experiments.ablation(*parts, ["a", "b", "c"], lambda n: ml.joint_fits(n, QUICK), "label", "id", leave_out)
    assert sorted(made) == [3, 6, 9]
    f1 = {(r[0], r[1]): r[4] for r in rows if r[3] == "f1"}
    assert len(f1) == 18
    assert (f1["a", "logistic_regression"] > 0.6) != (f1["b", "logistic_regression"] > 0.6) or leave_out


def test_the_fits_are_those_of_their_columns_alone(parts):
    """Without `a` the fits are the same as on a vector that has only `b` and `c`."""
    train, test = parts
    rows = experiments.ablation(train, test, ["a", "b", "c"], lambda n: ml.joint_fits(n, QUICK), "label", "id", True)
    alone = experiments.compare_models(ml.joint_fits(4, QUICK), train, test, "label", "a", "bc", "id")
    assert [r[:4] for r in rows[: len(alone)]] == [r[:4] for r in alone]
    assert np.allclose([r[4] for r in rows[: len(alone)]], [r[4] for r in alone])


def test_partial_sums_do_not_grow_with_the_blocks(spark, monkeypatch):
    """A step of the linear fits is one stage, with one sum a core."""
    monkeypatch.setattr(lines, "BLOCK_CELLS", 4)
    rows = spark.range(300).select((F.col("id") % 2).cast("int").alias("y"), F.array(F.rand(3), F.rand(4)).alias("v")).repartition(40)
    blocks, n = lines.packed_rows(rows, "v", "y", None)
    seen = []
    plain = type(blocks).collect
    monkeypatch.setattr(type(blocks), "collect", lambda df: seen.append(plain(df)) or seen[-1])
    found = lines.slopes_at(blocks, [lines.LineFit()], {0: (1.0, np.zeros(3))}, n)
    assert len(seen[0]) <= spark.sparkContext.defaultParallelism
    assert abs(found[0][0] - 300 * np.log(2)) < 1e-9


@pytest.mark.parametrize("by_level", [False, True])
def test_trees_draw_from_their_columns_only(parts, by_level):
    train = parts[0].withColumn("v", F.col("bc"))
    fits = [trees.TreeFit("gini", 3, 4, columns=0.5, per_node=True, bootstrap=True, only=(1, 3)), trees.TreeFit("boost", 3, 3, only=(0,))]
    model = trees.fit_trees(train, fits, "v", "label", "id", in_task=0 if by_level else trees.IN_TASK)
    used = {f: {r["feature"] for r in model.rows.filter(f"fit = {f} AND feature >= 0").collect()} for f in (0, 1)}
    assert used == {0: {1, 3}, 1: {0}}
