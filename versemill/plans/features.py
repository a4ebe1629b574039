"""Encoding, scaling, naive Bayes, split gain, linear fits."""

from __future__ import annotations

from pyspark.ml.feature import FeatureHasher
from pyspark.sql import functions as F

from versemill.functions.scalars import hash_key, hash_unit
from versemill.operators import bayes, encoding, impurity, metrics, terms
from versemill.plans.evaluation import round_rates
from versemill.plans.registry import query, table
from versemill.plans.sampling import STRATIFIED, split_stratified
from versemill.plans.texts import sql_vocab
from versemill.plans.views import (
    VECTORS,
    WORD_COUNTS,
    sql_hash,
    sql_unit,
    vectors,
)
from versemill.session import cut_lineage, spread


def _customers(spark, folder):
    part = F.when(hash_unit(hash_key(3, F.col("c_custkey"))) < 0.2, "test").otherwise("train")
    return table(spark, folder, "customer").withColumn("part", part)


CUSTOMERS = f"""customers AS (SELECT *, CASE WHEN {sql_unit(sql_hash(3, 'c_custkey'))} < 0.2 THEN 'test' ELSE 'train' END AS part
  FROM customer)"""


@query(
    "one_hot",
    f"""WITH {CUSTOMERS}, f AS (SELECT c_custkey, part, 'c_mktsegment=' || c_mktsegment AS feature FROM customers
            UNION ALL SELECT c_custkey, part, 'c_name=' || c_name FROM customers)
        SELECT c_custkey, feature, 1.0::DOUBLE AS value FROM f
        WHERE part = 'test' AND feature IN (SELECT feature FROM f WHERE part = 'train')""",
)
def one_hot(spark, folder):
    """Names are unknown to the training part, so they give no indicator."""
    rows = _customers(spark, folder)
    train, test = (rows.filter(F.col("part") == p) for p in ("train", "test"))
    return encoding.one_hot(train, test, "c_custkey", ["c_mktsegment", "c_name"])


@query(
    "dummies_align",
    """WITH p AS (SELECT o_orderkey, o_orderpriority AS c FROM orders WHERE o_orderstatus = 'F'),
         cats AS (SELECT list(DISTINCT o_orderpriority ORDER BY o_orderpriority) AS cs FROM orders
                  WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW')
       SELECT o_orderkey, array_to_string(list_transform(cs, lambda x: (x = c)::INTEGER), ',') AS indicators FROM p, cats""",
)
def dummies_align(spark, folder):
    """One priority does not occur in the training part."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    train = orders.filter("o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'")
    rows = encoding.dummies_align(train, orders.filter("o_orderstatus = 'F'"), "o_orderkey", "o_orderpriority")
    return rows.select("o_orderkey", F.array_join(F.transform("indicators", lambda x: x.cast("string")), ",").alias("indicators"))


@query(
    "feature_hash",
    """WITH f AS (SELECT o_orderkey, unnest(['o_orderstatus=' || o_orderstatus, 'o_orderpriority=' || o_orderpriority,
          'o_custkey=' || o_custkey]) AS feature FROM orders)
       SELECT o_orderkey, ('0x' || substr(md5(feature), 1, 8))::BIGINT % 2048 AS bucket, count(*)::DOUBLE AS value FROM f GROUP BY ALL""",
)
def feature_hash(spark, folder):
    return encoding.feature_hash(table(spark, folder, "orders"), "o_orderkey", ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query(
    "ordinal_encode",
    """WITH f AS (SELECT event_type, min(event_id) AS first FROM events GROUP BY event_type),
         c AS (SELECT event_type, row_number() OVER (ORDER BY first) - 1 AS code FROM f)
       SELECT event_id, event_type, code FROM events JOIN c USING (event_type)""",
)
def ordinal_encode(spark, folder):
    return encoding.ordinal_encode(table(spark, folder, "events").select("event_id", "event_type"), "event_id", "event_type")


_SCALED = ["l_quantity", "l_extendedprice", "l_discount", "flat"]


def _lines(spark, folder):
    part = F.when(hash_unit(hash_key(3, F.col("l_orderkey"))) < 0.2, "test").otherwise("train")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", F.lit(3.0).alias("flat"), part.alias("part")
    )


LINES = f"""lines AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, 3.0::DOUBLE AS flat,
  CASE WHEN {sql_unit(sql_hash(3, 'l_orderkey'))} < 0.2 THEN 'test' ELSE 'train' END AS part FROM lineitem)"""


def _sql_scaled(measure: str) -> str:
    shown = ", ".join(f"round({measure.format(c=c)}, 6) AS {c}" for c in _SCALED)
    fits = ", ".join(
        f"min({c}) AS {c}_min, max({c}) AS {c}_max, avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std" for c in _SCALED
    )
    return f"""WITH {LINES}, fit AS (SELECT {fits} FROM lines WHERE part = 'train')
      SELECT l_orderkey, l_linenumber, {shown} FROM lines, fit WHERE part = 'test'"""


def _scaled(spark, folder, scale):
    lines = _lines(spark, folder)
    train, test = (lines.filter(F.col("part") == p) for p in ("train", "test"))
    return scale(train, test, _SCALED).select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in _SCALED])


@query("minmax_fit_apply", _sql_scaled("({c} - {c}_min) / CASE WHEN {c}_max > {c}_min THEN {c}_max - {c}_min ELSE 1 END"))
def minmax_fit_apply(spark, folder):
    return _scaled(spark, folder, encoding.minmax_apply)


@query("standardize", _sql_scaled("({c} - {c}_mean) / CASE WHEN {c}_std > 0 THEN {c}_std ELSE 1 END"))
def standardize(spark, folder):
    return _scaled(spark, folder, encoding.standardize)


@query(
    "concat_features",
    """WITH c AS (SELECT vec_id, list_concat(embedding::DOUBLE[], [n_chars::DOUBLE, (lang = 'en')::INTEGER::DOUBLE]) AS v
        FROM embeddings JOIN documents ON doc_id = vec_id)
       SELECT vec_id, generate_subscripts(v, 1) - 1 AS dim, unnest(v) AS value FROM c""",
)
def concat_features(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars", "lang")
    rows = table(spark, folder, "embeddings").join(docs, F.col("doc_id") == F.col("vec_id"))
    number = F.array(F.col("n_chars").cast("double"), (F.col("lang") == "en").cast("int").cast("double"))
    both = rows.select("vec_id", F.posexplode(encoding.concat_features(F.col("embedding"), number)).alias("d", "value"))
    return both.select("vec_id", F.col("d").cast("bigint").alias("dim"), "value")


@query(
    "mean_pool",
    f"""WITH m AS (SELECT label, ({sql_unit(sql_hash(5, 'vec_id'))} < 0.7)::INTEGER AS m, generate_subscripts(embedding, 1) - 1 AS dim,
          unnest(embedding)::DOUBLE AS x FROM embeddings)
        SELECT label, dim, round(sum(m * x) / greatest(sum(m), 1e-9::DOUBLE), 6) AS value FROM m GROUP BY label, dim""",
)
def mean_pool(spark, folder):
    mask = (hash_unit(hash_key(5, F.col("vec_id"))) < 0.7).cast("int")
    pooled = encoding.mean_pool(table(spark, folder, "embeddings"), "label", "embedding", mask)
    return pooled.select("label", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value"))


# Naive Bayes on term counts: fitted on the training part, scored on the test part.
_NB = (
    f"""{WORD_COUNTS}, {STRATIFIED},
  known AS (SELECT c.*, toxic, part FROM counts c JOIN split USING (doc_id)),
  freq AS (SELECT term, count(*) AS df, sum(tf) AS total FROM known WHERE part = 'train' GROUP BY term),
  """
    + sql_vocab("total", "(SELECT count(*) FROM split WHERE part = 'train')")
    + """,
  sums AS (SELECT term, coalesce(sum(tf) FILTER (toxic = 0), 0) AS n0, coalesce(sum(tf) FILTER (toxic = 1), 0) AS n1
           FROM known JOIN vocab USING (term) WHERE part = 'train' GROUP BY term),
  probs AS (SELECT term, (n0 + 1) / (SELECT sum(n0) + count(*) FROM sums) AS p0, (n1 + 1) / (SELECT sum(n1) + count(*) FROM sums) AS p1 FROM sums),
  prior AS (SELECT avg((toxic = 0)::INTEGER) AS c0, avg((toxic = 1)::INTEGER) AS c1 FROM split WHERE part = 'train'),
  scores AS (SELECT doc_id, toxic, ln(c0) + coalesce(s0, 0) AS s0, ln(c1) + coalesce(s1, 0) AS s1 FROM split
    LEFT JOIN (SELECT doc_id, sum(tf * ln(p0)) AS s0, sum(tf * ln(p1)) AS s1 FROM known JOIN probs USING (term) GROUP BY doc_id) USING (doc_id), prior
    WHERE part = 'test'),
  predicted AS (SELECT doc_id, toxic AS label, (s1 > s0)::INTEGER AS pred, 1 / (1 + exp(least(s0, s1) - greatest(s0, s1))) AS confidence FROM scores)"""
)


def _nb_fit(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    split = cut_lineage(split_stratified(spark, folder))
    words = terms.preprocess(F.col("text"))
    # The label goes along as part of the key, so term rows are never joined by document.
    labelled = spread(docs, "doc_id").join(split, "doc_id").withColumn("key", F.struct("doc_id", "toxic"))
    train, test = (labelled.filter(F.col("part") == p) for p in ("train", "test"))
    priors, n_train = bayes.class_priors(split.filter("part = 'train'"), "toxic")
    counts = terms.term_counts(train, "key", words).withColumn("toxic", F.col("key.toxic"))
    fitted = bayes.multinomial_fit(counts, "toxic", list(priors), n_train)
    return fitted, priors, test, terms.term_counts(test, "doc_id", words)


def _nb_predicted(spark, folder):
    fitted, priors, test, counts = _nb_fit(spark, folder)
    return bayes.multinomial_predict(test.select("doc_id", "toxic"), counts, fitted, "doc_id", priors)


@query("nb_multinomial", f"WITH {_NB} SELECT doc_id, label AS toxic, pred AS predicted, round(confidence, 6) AS confidence FROM predicted")
def nb_multinomial(spark, folder):
    return _nb_predicted(spark, folder).withColumn("confidence", F.round("confidence", 6))


@query(
    "nb_text_metrics",
    f"""WITH {_NB}, c AS (SELECT count(*) FILTER (label = 1 AND pred = 1) AS tp, count(*) FILTER (label = 0 AND pred = 1) AS fp,
            count(*) FILTER (label = 1 AND pred = 0) AS fn, count(*) FILTER (label = 0 AND pred = 0) AS tn FROM predicted)
        SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS "precision",
          round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
          round(CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM c""",
)
def nb_text_metrics(spark, folder):
    return round_rates(metrics.binary_metrics(_nb_predicted(spark, folder), "toxic", "predicted"))


@query(
    "nb_feature_ratio",
    f"""WITH {_NB}, r AS (SELECT term, round(ln(p1) - ln(p0), 9) AS ratio FROM probs)
        SELECT * FROM (SELECT term, ratio, 'top' AS side FROM r ORDER BY ratio DESC, term LIMIT 20)
        UNION ALL SELECT * FROM (SELECT term, ratio, 'bottom' AS side FROM r ORDER BY ratio, term LIMIT 20)""",
)
def nb_feature_ratio(spark, folder):
    ratios = bayes.feature_ratio(_nb_fit(spark, folder)[0]).withColumn("ratio", F.round("ratio", 9))
    return bayes.top_and_bottom(ratios)


# Gaussian naive Bayes: fitted on the training part, scored on the test part.
_GNB = f"""{VECTORS}, {STRATIFIED}, parted AS (SELECT v.vec_id, v.embedding, v.toxic, part FROM vectors v JOIN split ON split.doc_id = v.vec_id),
  long AS (SELECT vec_id, toxic, part, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM parted),
  fit AS (SELECT toxic, dim, avg(x) AS mean, var_pop(x) + 1e-9::DOUBLE * (SELECT max(v) FROM (SELECT var_pop(x) AS v FROM long WHERE part = 'train' GROUP BY dim)) AS var
    FROM long WHERE part = 'train' GROUP BY toxic, dim),
  prior AS (SELECT toxic, count(*) / (SELECT count(*) FROM parted WHERE part = 'train') AS share FROM parted WHERE part = 'train' GROUP BY toxic),
  score AS (SELECT l.vec_id, f.toxic, ln(any_value(share)) - 0.5::DOUBLE * sum(ln(6.283185307179586::DOUBLE * var) + (x - mean) * (x - mean) / var) AS s
    FROM long l JOIN fit f USING (dim) JOIN prior p ON p.toxic = f.toxic WHERE l.part = 'test' GROUP BY l.vec_id, f.toxic)"""


def _vector_parts(spark, folder):
    split = split_stratified(spark, folder).select(F.col("doc_id").alias("vec_id"), "part")
    rows = cut_lineage(vectors(spark, folder).select("vec_id", "embedding", "toxic").join(split, "vec_id"))
    return [rows.filter(F.col("part") == p) for p in ("train", "test")]


@query("nb_gaussian", f"WITH {_GNB} SELECT vec_id, v.toxic, max_by(s.toxic, s.s) AS predicted FROM vectors v JOIN score s USING (vec_id) GROUP BY vec_id, v.toxic")
def nb_gaussian(spark, folder):
    train, test = _vector_parts(spark, folder)
    fitted = bayes.gaussian_table(train, "toxic", "embedding")
    predicted = bayes.gaussian_predict(test, fitted, bayes.class_priors(train, "toxic")[0], "embedding")
    return predicted.select("vec_id", "toxic", "predicted")


@query("nb_gaussian_table", f"WITH {_GNB} SELECT toxic AS label, dim - 1 AS dim, round(mean, 6) AS mean, round(var, 9) AS var FROM fit")
def nb_gaussian_table(spark, folder):
    fitted = bayes.gaussian_table(_vector_parts(spark, folder)[0], "toxic", "embedding")
    return fitted.select("label", F.col("dim").cast("bigint").alias("dim"), F.round("mean", 6).alias("mean"), F.round("var", 9).alias("var"))


_SPLIT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


def _sql_gains(kind: str) -> str:
    if kind == "gini":
        form = "(1 - ({o} / {n}) * ({o} / {n}) - (1 - {o} / {n}) * (1 - {o} / {n}))"
    else:
        form = "(-(CASE WHEN {o} > 0 THEN {o} / {n} * log2({o} / {n}) ELSE 0 END) - (CASE WHEN {o} < {n} THEN (1 - {o} / {n}) * log2(1 - {o} / {n}) ELSE 0 END))"
    points = "[" + ", ".join(f"{p}::DOUBLE" for p in impurity.PERCENTILES) + "]"
    cuts = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, unnest(quantile_cont({f}, {points})) AS q FROM lineitem" for f in _SPLIT_FEATURES
    )
    long = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x, (l_linestatus = 'O')::INTEGER AS y FROM lineitem" for f in _SPLIT_FEATURES)
    return f"""WITH cuts AS (SELECT DISTINCT feature, q FROM ({cuts})),
      mids AS (SELECT feature, (q + lead(q) OVER (PARTITION BY feature ORDER BY q)) / 2 AS threshold FROM cuts),
      long AS ({long}),
      sums AS (SELECT l.feature, threshold, count(*) AS n, sum(y) AS o, count(*) FILTER (x <= threshold) AS nl,
          coalesce(sum(y) FILTER (x <= threshold), 0) AS ol
        FROM long l JOIN mids m ON l.feature = m.feature AND threshold IS NOT NULL GROUP BY ALL HAVING nl > 0 AND nl < n)
      SELECT feature, round(threshold, 6) AS threshold, round({form.format(o='o', n='n')} - nl / n * {form.format(o='ol', n='nl')}
        - (n - nl) / n * {form.format(o='(o - ol)', n='(n - nl)')}, 9) AS gain FROM sums"""


def _gains(spark, folder, kind):
    lines = table(spark, folder, "lineitem").withColumn("y", (F.col("l_linestatus") == "O").cast("int"))
    gains = impurity.split_gains(lines, {c: F.col(c) for c in _SPLIT_FEATURES}, "y", kind)
    return gains.select("feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 9).alias("gain"))


@query("split_gain", _sql_gains("gini"))
def split_gain(spark, folder):
    return _gains(spark, folder, "gini")


@query("split_gain_entropy", _sql_gains("entropy"))
def split_gain_entropy(spark, folder):
    return _gains(spark, folder, "entropy")


@query("best_split", f"SELECT * FROM ({_sql_gains('gini')}) ORDER BY gain DESC, feature, threshold LIMIT 1")
def best_split(spark, folder):
    return impurity.best_split(split_gain(spark, folder))
