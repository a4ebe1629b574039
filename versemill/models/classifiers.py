"""The classifiers that are compared, with their settings: those fitted together, and MLlib estimators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.models import gauss, lines, nets, trees
from versemill.operators import metrics


@dataclass(frozen=True)
class Settings:
    """Sizes of the models; the defaults are those of the full experiments."""

    iterations: int = 1000
    tree_depth: int = 10
    trees: int = 200
    forest_depth: int = 15
    rounds: int = 200
    boost_depth: int = 8
    seed: int = 42


def with_vector(df: DataFrame, vec_col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(vec_col).cast("array<double>")))


def _columns(label: str, features: str) -> dict:
    return {"labelCol": label, "featuresCol": features}


def logistic_regression(
    n: int, label="label", features="features", c: float = 1.0, penalty: str = "l2", settings: Settings = Settings()
) -> LogisticRegression:
    """`c` is the inverse penalty of a sum over n rows; here the loss is their mean."""
    return LogisticRegression(
        regParam=0.0 if penalty == "none" else 1.0 / (c * n),
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        maxIter=settings.iterations,
        tol=1e-6,
        standardization=False,
        **_columns(label, features),
    )


def linear_svm(n: int, label="label", features="features", c: float = 1.0, settings: Settings = Settings()) -> LinearSVC:
    return LinearSVC(regParam=1.0 / (c * n), maxIter=settings.iterations, standardization=False, threshold=0.0, **_columns(label, features))


#: Hidden layers of the nets that are compared.
NETS = {"1": [32], "5": [512, 256, 128, 64], "6": [1024, 512, 256, 128, 64, 32]}


def naive_bayes(label="label", features="features", counts: bool = False) -> NaiveBayes:
    """Multinomial on non-negative weights (TF-IDF), else Gaussian."""
    return NaiveBayes(modelType="multinomial" if counts else "gaussian", smoothing=1.0, **_columns(label, features))


def joint_fits(n_features: int, settings: Settings = Settings()) -> dict[str, trees.TreeFit | lines.LineFit | gauss.GaussFit]:
    """The classifiers that are compared; those of a kind are fitted together."""
    return {
        "logistic_regression": lines.LineFit("logistic"),
        "linear_svm": lines.LineFit("hinge"),
        "naive_bayes": gauss.GaussFit(),
        "decision_tree": trees.decision_tree("entropy", settings.tree_depth, seed=settings.seed),
        "random_forest": trees.random_forest(n_features, settings.trees, settings.forest_depth, seed=settings.seed),
        "gradient_boosting": trees.gradient_boosting(settings.rounds, settings.boost_depth, seed=settings.seed),
    }


def score(predictions: DataFrame, label: str = "label") -> dict[str, float]:
    """Accuracy, precision, recall and F1 of a prediction column, from one pass."""
    return metrics.binary_metrics(predictions, label, "prediction").head().asDict()


def train_mlp(train: DataFrame, validation: DataFrame, hidden: list[int], n_features: int, **more) -> nets.Net:
    """One net; `nets.fit_nets` says which of its stages, and takes the further settings."""
    return nets.fit_nets(train, validation, {"net": hidden}, n_features, **more)["net"]
