"""Ranks of models over data sets and the tests behind the critical-difference plot."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from versemill.operators import comparisons
from versemill.plans.registry import query
from versemill.plans.views import RUNS, runs


def _errors(spark, folder):
    return runs(spark, folder).select("dataset", "model", "error")


_RANKED = RUNS + ", ranked AS (SELECT dataset, model, error, rank() OVER (PARTITION BY dataset ORDER BY error) AS rank FROM runs)"


@query("rank_min", f"WITH {_RANKED} SELECT * FROM ranked")
def rank_min(spark, folder):
    return comparisons.rank_min(_errors(spark, folder), "dataset", "error")


@query(
    "rank_summary",
    f"""WITH {_RANKED} SELECT 'Sum Ranks' AS row, model, round(sum(rank)::DOUBLE, 3) AS value FROM ranked GROUP BY model
        UNION ALL SELECT 'Average Ranks', model, round(avg(rank), 3) FROM ranked GROUP BY model""",
)
def rank_summary(spark, folder):
    return comparisons.rank_summary(rank_min(spark, folder), "model")


@query(
    "rank_table",
    f"""WITH {_RANKED} SELECT dataset::VARCHAR AS dataset, model, round(error, 3) || ' (' || rank || ')' AS shown FROM ranked
        UNION ALL SELECT 'Sum Ranks', model, round(sum(rank)::DOUBLE, 3)::VARCHAR FROM ranked GROUP BY model
        UNION ALL SELECT 'Average Ranks', model, round(avg(rank), 3)::VARCHAR FROM ranked GROUP BY model""",
)
def rank_table(spark, folder):
    """`error (rank)` per data set, with the rank sums and means as further rows."""
    ranked = rank_min(spark, folder)
    shown = F.concat(F.round("error", 3).cast("string"), F.lit(" ("), F.col("rank").cast("string"), F.lit(")"))
    rows = ranked.select(F.col("dataset").cast("string").alias("dataset"), "model", shown.alias("shown"))
    summary = comparisons.rank_summary(ranked, "model")
    return rows.unionByName(summary.select(F.col("row").alias("dataset"), "model", F.col("value").cast("string").alias("shown")))


@query(
    "friedman",
    f"""WITH {RUNS}, complete AS (SELECT dataset FROM runs GROUP BY dataset HAVING count(DISTINCT model) = (SELECT count(DISTINCT model) FROM runs)),
        w AS (SELECT * FROM runs WHERE dataset IN (SELECT dataset FROM complete)),
        r AS (SELECT model, rank() OVER (PARTITION BY dataset ORDER BY error) + (count(*) OVER (PARTITION BY dataset, error) - 1) / 2 AS rk,
          count(*) OVER (PARTITION BY dataset, error) AS t FROM w),
        m AS (SELECT model, sum(rk) AS s, sum(t * t - 1) AS tie, count(*) AS n FROM r GROUP BY model),
        a AS (SELECT count(*) AS k, max(n) AS n, sum(s * s) AS sq, sum(tie) AS ties FROM m)
        SELECT n AS n_datasets, (SELECT count(DISTINCT dataset) FROM runs) - n AS n_incomplete, k AS n_models,
          round((12 / (n * k * (k + 1)) * sq - 3 * n * (k + 1)) / (1 - ties / (n * k * (k * k - 1))), 6) AS statistic FROM a""",
)
def friedman(spark, folder):
    result = comparisons.friedman(_errors(spark, folder), "dataset", "model", "error")
    return result.drop("p_value").withColumn("statistic", F.round("statistic", 6))


_PAIRS = f"""{RUNS}, d AS (SELECT a.model AS first, b.model AS second, round(a.error - b.error, 9) AS gap
      FROM runs a JOIN runs b ON a.dataset = b.dataset AND a.model < b.model),
    r AS (SELECT first, second, gap, rank() OVER (PARTITION BY first, second ORDER BY abs(gap))
      + (count(*) OVER (PARTITION BY first, second, abs(gap)) - 1) / 2 AS rk, count(*) OVER (PARTITION BY first, second, abs(gap)) AS t
      FROM d WHERE gap <> 0),
    s AS (SELECT first, second, count(*) AS n, least(coalesce(sum(rk) FILTER (gap > 0), 0), coalesce(sum(rk) FILTER (gap < 0), 0)) AS low,
      sum(t * t - 1) AS ties FROM r GROUP BY first, second),
    p AS (SELECT first, second, coalesce(n, 0) AS n, coalesce(low, 0)::DOUBLE AS low, coalesce(ties, 0) AS ties
      FROM (SELECT DISTINCT first, second FROM d) LEFT JOIN s USING (first, second))"""
#: |z| at which a two-sided test at 0.05 / j rejects, for Holm's j-th last pair.
_CRITICAL = ", ".join(f"({j}, {NormalDist().inv_cdf(1 - 0.05 / (2 * j))!r})" for j in range(1, 401))


@query("wilcoxon_holm", f"WITH {_PAIRS} SELECT first, second, n, round(low, 6) AS statistic FROM p")
def wilcoxon_holm(spark, folder):
    result = comparisons.wilcoxon_holm(_errors(spark, folder), "dataset", "model", "error")
    return result.select("first", "second", "n", F.round("statistic", 6).alias("statistic"))


@query(
    "wilcoxon_holm_decisions",
    f"""WITH {_PAIRS}, c(j, z) AS (VALUES {_CRITICAL}),
        v AS (SELECT *, sqrt((n * (n + 1) * (2 * n + 1) - ties / 2) / 24) AS spread FROM p),
        z AS (SELECT first, second, CASE WHEN spread > 0 THEN round(abs((low - n * (n + 1) / 4) / spread), 9) ELSE 0 END AS z FROM v),
        o AS (SELECT *, row_number() OVER (ORDER BY z DESC, first, second) AS place, count(*) OVER () AS m FROM z)
        SELECT first, second, place::INTEGER AS holm_order, bool_and(o.z >= c.z) OVER (ORDER BY place) AS rejected
        FROM o JOIN c ON c.j = m - place + 1""",
)
def wilcoxon_holm_decisions(spark, folder):
    result = comparisons.wilcoxon_holm(_errors(spark, folder), "dataset", "model", "error")
    return result.select("first", "second", "holm_order", "rejected")
