"""Metrics, votes, leaderboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from versemill.functions.scalars import hash_key, hash_unit, sigmoid_clip
from versemill.functions.text import answer_to_label as to_label
from versemill.functions.text import token_estimate
from versemill.operators import joins, metrics
from versemill.operators.sampling import smallest_digests
from versemill.plans.registry import query, table
from versemill.plans.views import RUNS, VOTES, runs, sql_hash, sql_unit, votes


def _predicted(spark, folder):
    v = votes(spark, folder)
    return v.withColumn("pred", metrics.apply_threshold(F.col("score"), 0.5)).withColumn("said", to_label(F.col("answer")))


PREDICTED = VOTES + """, predicted AS (
  SELECT *, (score >= 0.5)::INTEGER AS pred, (lower(answer) = 'explicit')::INTEGER AS said FROM votes)"""


@query("apply_threshold", f"WITH {PREDICTED} SELECT doc_id, score, pred FROM predicted")
def apply_threshold(spark, folder):
    return _predicted(spark, folder).select("doc_id", "score", "pred")


@query("llm_answer_to_label", f"WITH {PREDICTED} SELECT doc_id, answer, said FROM predicted")
def llm_answer_to_label(spark, folder):
    return _predicted(spark, folder).select("doc_id", "answer", "said")


@query(
    "label_distribution",
    f"""SELECT CASE WHEN {sql_unit(sql_hash(7, 'doc_id'))} < 0.2 THEN 'test' ELSE 'train' END AS part, toxic, count(*) AS n
        FROM labels GROUP BY ALL""",
)
def label_distribution(spark, folder):
    part = F.when(hash_unit(hash_key(7, F.col("doc_id"))) < 0.2, "test").otherwise("train")
    return metrics.label_distribution(table(spark, folder, "labels").withColumn("part", part), "toxic", "part")


_MATRIX = PREDICTED + """, matrix AS (
  SELECT a::INTEGER AS actual, p::INTEGER AS predicted, count(label) AS n
  FROM (SELECT unnest([0, 1]) AS a) CROSS JOIN (SELECT unnest([0, 1]) AS p)
  LEFT JOIN predicted ON label = a AND pred = p GROUP BY ALL)"""


@query("confusion_matrix", f"WITH {_MATRIX} SELECT * FROM matrix")
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_predicted(spark, folder), "label", "pred")


@query(
    "confusion_percent",
    f"""WITH {_MATRIX} SELECT actual, predicted, round(n / sum(n) OVER (PARTITION BY actual) * 100, 6) AS percent FROM matrix""",
)
def confusion_percent(spark, folder):
    return metrics.confusion_percent(confusion_matrix(spark, folder)).withColumn("percent", F.round("percent", 6))


_COUNTS = """(SELECT count(*) FILTER (label = 1 AND pred = 1) AS tp, count(*) FILTER (label = 0 AND pred = 1) AS fp,
  count(*) FILTER (label = 1 AND pred = 0) AS fn, count(*) FILTER (label = 0 AND pred = 0) AS tn FROM predicted)"""
_RATES = """round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS "precision",
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1"""


def round_rates(df, digits: int = 6):
    names = ("accuracy", "precision", "recall", "f1")
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


@query("binary_metrics", f"WITH {PREDICTED} SELECT {_RATES} FROM {_COUNTS}")
def binary_metrics(spark, folder):
    return round_rates(metrics.binary_metrics(_predicted(spark, folder), "label", "pred"))


@query(
    "classification_report",
    f"""WITH {PREDICTED}, c AS (
          SELECT k, count(*) FILTER (label = k) AS support, count(*) FILTER (pred = k) AS said,
            count(*) FILTER (label = k AND pred = k) AS tp
          FROM predicted, (SELECT unnest([0, 1]) AS k) GROUP BY k),
        r AS (SELECT k::VARCHAR AS class, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS "precision",
            CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall, 2 * tp / (said + support) AS f1, support FROM c)
        SELECT class, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM (
          SELECT * FROM r
          UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support) FROM r
          UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
            sum(f1 * support) / sum(support), sum(support) FROM r)""",
)
def classification_report(spark, folder):
    return round_rates(metrics.classification_report(_predicted(spark, folder), "label", "pred"))


@query(
    "roc_auc",
    f"""WITH {VOTES}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM votes)
        SELECT round((sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
          / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 9) AS auc FROM r""",
)
def roc_auc(spark, folder):
    return metrics.roc_auc(votes(spark, folder), "score", "label").select(F.round("auc", 9).alias("auc"))


_SWEEP = VOTES + f""", sweep AS (SELECT t AS threshold,
    CASE WHEN count(*) FILTER (label = 1 AND score >= t) > 0 THEN
      2 * count(*) FILTER (label = 1 AND score >= t) / (count(*) FILTER (label = 1) + count(*) FILTER (score >= t)) ELSE 0 END AS f1
  FROM votes, (SELECT unnest([{', '.join(repr(t) + '::DOUBLE' for t in metrics.thresholds())}]) AS t) GROUP BY t)"""


@query("threshold_sweep", f"WITH {_SWEEP} SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM sweep")
def threshold_sweep(spark, folder):
    sweep = metrics.threshold_sweep(votes(spark, folder), "score", "label")
    return sweep.select(F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"))


@query(
    "best_threshold",
    f"""WITH {_SWEEP} SELECT round(CASE WHEN f1 > 0 THEN threshold ELSE 0.5 END, 6) AS threshold, round(f1, 6) AS f1
        FROM sweep ORDER BY sweep.f1 DESC, sweep.threshold LIMIT 1""",
)
def best_threshold(spark, folder):
    best = metrics.best_threshold(metrics.threshold_sweep(votes(spark, folder), "score", "label"))
    return best.select(F.round("threshold", 6).alias("threshold"), F.round("f1", 6).alias("f1"))


@query(
    "log_loss",
    f"""WITH {VOTES}, p AS (SELECT label, greatest(least(score, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE) AS p FROM votes)
        SELECT round(-avg(label * ln(p) + (1 - label) * ln(1 - p)), 6) AS log_loss FROM p""",
)
def log_loss(spark, folder):
    return metrics.log_loss(votes(spark, folder), "label", "score").select(F.round("log_loss", 6).alias("log_loss"))


@query(
    "regression_rmse",
    """SELECT round(avg((l_quantity * 1500 - l_extendedprice) * (l_quantity * 1500 - l_extendedprice)), 2) AS mse,
         round(sqrt(avg((l_quantity * 1500 - l_extendedprice) * (l_quantity * 1500 - l_extendedprice))), 4) AS rmse FROM lineitem""",
)
def regression_rmse(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("guess", F.col("l_quantity") * 1500)
    error = metrics.regression_error(lines, "l_extendedprice", "guess")
    return error.select(F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"))


@query(
    "token_cost",
    "SELECT sum(length(text) // 4)::BIGINT AS tokens, round(sum(length(text) // 4)::BIGINT / 1000 * 0.0004::DOUBLE, 9) AS cost FROM documents",
)
def token_cost(spark, folder):
    docs = table(spark, folder, "documents").select(token_estimate(F.col("text")).alias("tokens"))
    return metrics.token_cost(docs, "tokens", 0.0004).withColumn("cost", F.round("cost", 9))


# One run per (data set, model) stands for one fold of the model.
@query(
    "cv_summary",
    f"""WITH {RUNS}, m AS (SELECT model, 'accuracy' AS metric, accuracy AS value FROM runs UNION ALL SELECT model, 'f1', f1 FROM runs)
        SELECT model, metric, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std FROM m GROUP BY ALL""",
)
def cv_summary(spark, folder):
    long = metrics.long_metrics(runs(spark, folder), ["accuracy", "f1"], "model")
    return metrics.cv_summary(long, "metric", "value", "model")


@query("repeat_average", f"WITH {RUNS} SELECT model, round(avg(f1), 6) AS f1, count(*) AS repeats FROM runs GROUP BY model")
def repeat_average(spark, folder):
    return runs(spark, folder).groupBy("model").agg(F.round(F.avg("f1"), 6).alias("f1"), F.count("*").alias("repeats"))


@query(
    "leaderboard",
    f"WITH {RUNS} SELECT dataset, model, f1, row_number() OVER (PARTITION BY dataset ORDER BY f1 DESC, model) AS position FROM runs",
)
def leaderboard(spark, folder):
    return metrics.leaderboard(runs(spark, folder), "dataset", "model", "f1")


@query(
    "best_per_group",
    f"WITH {RUNS} SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY f1 DESC, model) = 1",
)
def best_per_group(spark, folder):
    return metrics.best_per_group(runs(spark, folder), "dataset", "model", "f1")


@query("best_overall", f"WITH {RUNS} SELECT * FROM runs ORDER BY f1 DESC, dataset, model LIMIT 1")
def best_overall(spark, folder):
    return metrics.best_overall(runs(spark, folder), "f1", "dataset", "model")


@query(
    "error_listing",
    f"""WITH {PREDICTED} SELECT doc_id, label, pred, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS shown,
          round(greatest(score, 1 - score), 3) AS confidence
        FROM predicted JOIN documents USING (doc_id) WHERE label <> pred ORDER BY doc_id LIMIT 10""",
)
def error_listing(spark, folder):
    docs = table(spark, folder, "documents")
    return metrics.error_listing(_predicted(spark, folder), docs, "doc_id", "label", "pred", "score", "text")


@query("pseudo_label_vote", f"""WITH {PREDICTED} SELECT doc_id, label, pred, said, CASE
    WHEN label = pred AND pred = said THEN label WHEN pred = 1 AND said = 1 THEN 1
    WHEN label = 1 AND pred = 0 AND said = 0 THEN 1 WHEN label + pred + said >= 2 THEN 1 ELSE 0 END AS voted FROM predicted""")
def pseudo_label_vote(spark, folder):
    v = _predicted(spark, folder)
    voted = metrics.pseudo_label_vote(F.col("label"), F.col("pred"), F.col("said"))
    return v.select("doc_id", "label", "pred", "said", voted.alias("voted"))


@query(
    "label_change_report",
    f"""WITH {PREDICTED}, v AS (SELECT label, CASE WHEN label = 1 OR pred + said = 2 THEN 1 ELSE 0 END AS voted FROM predicted)
        SELECT count(*) AS n, count(*) FILTER (label <> voted) AS changed,
          round(count(*) FILTER (label <> voted) / count(*) * 100, 6) AS percent FROM v""",
)
def label_change_report(spark, folder):
    return metrics.label_change_report(pseudo_label_vote(spark, folder), "label", "voted")


@query("align_predictions", f"WITH {PREDICTED} SELECT doc_id, label, pred, said FROM predicted WHERE doc_id IN (SELECT vec_id FROM embeddings)")
def align_predictions(spark, folder):
    """Three sources held apart; the second covers only the embedded documents."""
    v = _predicted(spark, folder)
    known = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return joins.align_predictions(
        v.select("doc_id", "label"),
        {"pred": v.select("doc_id", "pred").join(known, "doc_id", "left_semi"), "said": v.select("doc_id", "said")},
        "doc_id",
    )


_DISAGREE = PREDICTED + ", disagree AS (SELECT doc_id, score, said FROM predicted WHERE pred <> said)"


@query("disagreement_rows", f"WITH {_DISAGREE} SELECT doc_id, score, said, text FROM disagree JOIN documents USING (doc_id)")
def disagreement_rows(spark, folder):
    wrong = joins.disagreement_rows(_predicted(spark, folder), "score", "said").select("doc_id", "score", "said")
    return wrong.join(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")


@query("sample_disagreements", f"WITH {_DISAGREE} SELECT doc_id FROM disagree ORDER BY {sql_hash(42, 'doc_id')}, doc_id LIMIT 5")
def sample_disagreements(spark, folder):
    wrong = joins.disagreement_rows(_predicted(spark, folder), "score", "said").select("doc_id")
    return smallest_digests(wrong, "doc_id", 5, seed=42)
