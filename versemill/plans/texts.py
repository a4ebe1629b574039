"""Text normalisation and TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from versemill.functions import text
from versemill.operators import terms
from versemill.plans.registry import query, table
from versemill.session import cut_lineage, spread
from versemill.plans.sampling import STRATIFIED, split_stratified
from versemill.plans.views import GRAMS, TOKENS, WORD_COUNTS, sql_clean, sql_content, sql_tokens


def _docs(spark, folder):
    return spread(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")


CLEAN = f"cleaned AS (SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents)"


@query("clean_text", f"WITH {CLEAN} SELECT doc_id, cleaned FROM cleaned")
def clean_text(spark, folder):
    return _docs(spark, folder).select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


def _letters(letters: str) -> str:
    return f"SELECT doc_id, regexp_replace(lower(text), '[^{letters}{text.SPACE}]', '', 'g') AS letters FROM documents"


@query("clean_letters_en", _letters("a-zA-Z"))
def clean_letters_en(spark, folder):
    return _docs(spark, folder).select("doc_id", text.clean_letters(F.col("text")).alias("letters"))


@query("clean_letters_es", _letters("a-záéíóúüñ"))
def clean_letters_es(spark, folder):
    return _docs(spark, folder).select("doc_id", text.clean_letters(F.col("text"), "spanish").alias("letters"))


@query(
    "tokenize",
    f"WITH {CLEAN}, t AS (SELECT doc_id, {sql_tokens('cleaned')} AS tokens FROM cleaned) "
    "SELECT doc_id, array_to_string(tokens, ' ') AS tokens, len(tokens)::INTEGER AS n_tokens FROM t",
)
def tokenize(spark, folder):
    split = _docs(spark, folder).select("doc_id", text.tokenize(text.clean_text(F.col("text"))).alias("t"))
    return split.select("doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").alias("n_tokens"))


@query(
    "remove_stopwords",
    f"""WITH {CLEAN}, t AS (SELECT doc_id, list_filter({sql_tokens('cleaned')}, lambda w: w NOT IN {tuple(text.ENGLISH_STOPWORDS)}) AS t
        FROM cleaned) SELECT doc_id, array_to_string(t, ' ') AS tokens FROM t""",
)
def remove_stopwords(spark, folder):
    tokens = text.remove_stopwords(text.tokenize(text.clean_text(F.col("text"))))
    return _docs(spark, folder).select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query("remove_stopwords_es")
def remove_stopwords_es(spark, folder):
    tokens = text.remove_stopwords(text.tokenize(text.clean_text(F.col("text"))), "spanish")
    return _docs(spark, folder).select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query("drop_short_tokens", f"WITH {CLEAN}, t AS (SELECT doc_id, list_filter({sql_tokens('cleaned')}, lambda w: length(w) > 2) AS t FROM cleaned) SELECT doc_id, array_to_string(t, ' ') AS tokens FROM t")
def drop_short_tokens(spark, folder):
    tokens = text.drop_short(text.tokenize(text.clean_text(F.col("text"))))
    return _docs(spark, folder).select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query("preprocess_text", f"WITH {TOKENS} SELECT doc_id, array_to_string(words, ' ') AS processed FROM tokens")
def preprocess_text(spark, folder):
    words = terms.preprocess(F.col("text"))
    return _docs(spark, folder).select("doc_id", F.array_join(words, " ").alias("processed"))


@query("drop_empty_text", f"WITH {TOKENS} SELECT doc_id, array_to_string(words, ' ') AS processed FROM tokens WHERE len(words) > 0")
def drop_empty_text(spark, folder):
    words = F.array_join(terms.preprocess(F.col("text")), " ")
    return terms.drop_empty(_docs(spark, folder), "doc_id", words, "processed")


def _word_counts(spark, folder):
    return terms.term_counts(_docs(spark, folder), "doc_id", terms.preprocess(F.col("text")))


def _gram_counts(spark, folder):
    return terms.term_counts(_docs(spark, folder), "doc_id", terms.preprocess(F.col("text")), 2)


@query("ngrams", f"WITH {GRAMS} SELECT doc_id, count(*) AS n_grams, count(DISTINCT term) AS n_distinct, md5(string_agg(term, ',' ORDER BY term)) AS digest FROM grams GROUP BY doc_id")
def ngrams(spark, folder):
    # A generated column is made once: a filter would move below a projection and make the words again.
    words = _docs(spark, folder).select("doc_id", F.explode(F.array(terms.preprocess(F.col("text")))).alias("w")).filter(F.size("w") > 0)
    grams = words.select("doc_id", F.array_sort(text.ngrams(F.col("w"))).alias("g"))
    return grams.select(
        "doc_id",
        F.size("g").cast("bigint").alias("n_grams"),
        F.size(F.array_distinct("g")).cast("bigint").alias("n_distinct"),
        F.md5(F.array_join("g", ",")).alias("digest"),
    )


@query("term_counts", f"WITH {WORD_COUNTS} SELECT doc_id, term, tf FROM counts")
def term_counts(spark, folder):
    return _word_counts(spark, folder).select("doc_id", "term", "tf")


@query("word_doc_frequency", f"WITH {GRAMS} SELECT term, count(*) AS df, sum(tf)::BIGINT AS total FROM counts GROUP BY term")
def word_doc_frequency(spark, folder):
    return terms.term_frequencies(_docs(spark, folder), terms.preprocess(F.col("text")), 2)


_FREQ = GRAMS + ", freq AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS total FROM counts GROUP BY term)"


def sql_vocab(by: str, n_docs: str = "(SELECT count(*) FROM documents)", freq: str = "freq", top: int = 5000) -> str:
    return f"""vocab AS (SELECT term, df, total FROM {freq} WHERE df >= 3 AND df <= 0.92::DOUBLE * {n_docs}
      ORDER BY {by} DESC, term LIMIT {top})"""


def _n_docs(spark, folder):
    return table(spark, folder, "documents").count()


@query("tfidf_vocab_df", f"WITH {_FREQ}, {sql_vocab('df')} SELECT * FROM vocab")
def tfidf_vocab_df(spark, folder):
    return terms.vocabulary(word_doc_frequency(spark, folder), _n_docs(spark, folder), by="df")


@query("tfidf_vocab_tf", f"WITH {_FREQ}, {sql_vocab('total')} SELECT * FROM vocab")
def tfidf_vocab_tf(spark, folder):
    return terms.vocabulary(word_doc_frequency(spark, folder), _n_docs(spark, folder))


@query("topk_terms", f"WITH {_FREQ} SELECT term, total FROM freq ORDER BY total DESC, term LIMIT 20")
def topk_terms(spark, folder):
    return word_doc_frequency(spark, folder).orderBy(F.desc("total"), "term").limit(20).select("term", "total")


@query(
    "tfidf_relative",
    f"""WITH {_FREQ}, {sql_vocab('df')}, lens AS (SELECT doc_id, sum(tf) AS len FROM counts GROUP BY doc_id)
        SELECT doc_id, term, round(tf / len * ln((SELECT count(*) FROM documents) / (df + 1)), 9) AS weight
        FROM counts JOIN vocab USING (term) JOIN lens USING (doc_id)""",
)
def tfidf_relative(spark, folder):
    weights = terms.tfidf_relative(_gram_counts(spark, folder), tfidf_vocab_df(spark, folder), _n_docs(spark, folder), "doc_id")
    return weights.withColumn("weight", F.round("weight", 9))


_SMOOTH = """raw AS (SELECT doc_id, term, tf * (ln((1 + {n})::DOUBLE / (1 + df)) + 1) AS w FROM {counts} JOIN vocab USING (term))
  SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 9) AS weight FROM raw"""


@query(
    "tfidf_smooth_l2",
    f"WITH {_FREQ}, {sql_vocab('total')}, " + _SMOOTH.format(n="(SELECT count(*) FROM documents)", counts="counts"),
)
def tfidf_smooth_l2(spark, folder):
    weights = terms.tfidf_smooth_l2(_gram_counts(spark, folder), tfidf_vocab_tf(spark, folder), _n_docs(spark, folder), "doc_id")
    return weights.withColumn("weight", F.round("weight", 9))


@query(
    "tfidf_train_test",
    f"""WITH {GRAMS}, {STRATIFIED}, train AS (SELECT c.* FROM counts c JOIN split s ON c.doc_id = s.doc_id WHERE part = 'train'),
        test AS (SELECT c.* FROM counts c JOIN split s ON c.doc_id = s.doc_id WHERE part = 'test'),
        freq AS (SELECT term, count(*) AS df, sum(tf) AS total FROM train GROUP BY term),
        """
    + sql_vocab("total", "(SELECT count(*) FROM split WHERE part = 'train')")
    + ", "
    + _SMOOTH.format(n="(SELECT count(*) FROM split WHERE part = 'train')", counts="test"),
)
def tfidf_train_test(spark, folder):
    """Vocabulary and document counts come from the training part alone."""
    parts = cut_lineage(split_stratified(spark, folder).select("doc_id", "part"))
    docs = _docs(spark, folder).join(parts, "doc_id")
    train, test = (docs.filter(F.col("part") == p) for p in ("train", "test"))
    n_train = parts.filter("part = 'train'").count()
    words = terms.preprocess(F.col("text"))
    vocab = terms.vocabulary(terms.word_doc_frequency(terms.term_counts(train, "doc_id", words, 2)), n_train)
    weights = terms.tfidf_smooth_l2(terms.term_counts(test, "doc_id", words, 2), vocab, n_train, "doc_id")
    return weights.withColumn("weight", F.round("weight", 9))


# Three short columns of customers: a normal one, one of stop words only, one constant word.
_SHORT = """short AS (SELECT c_custkey, lower(c_mktsegment) AS segment,
    CASE WHEN c_nationkey < 12 THEN 'you and them' ELSE 'all those' END AS filler,
    c_name AS name FROM customer)"""


@query(
    "empty_vocab_fallback",
    f"""WITH {_SHORT},
        seg AS (SELECT c_custkey, segment FROM short),
        fill AS (SELECT c_custkey, unnest(CASE filler WHEN 'you and them'
            THEN ['you', 'and', 'them', 'you and', 'and them'] ELSE ['all', 'those', 'all those'] END) AS term FROM short)
        SELECT 'segment' AS "column", 'tfidf' AS branch, count(*) AS n_values, count(DISTINCT segment) AS n_features,
          count(*)::DOUBLE AS total FROM seg
        UNION ALL SELECT 'filler', 'tfidf_with_stopwords', count(*), count(DISTINCT term),
          (SELECT round(count(*) FILTER (filler = 'you and them') * 5 / sqrt(5.0::DOUBLE)
                   + count(*) FILTER (filler <> 'you and them') * 3 / sqrt(3.0::DOUBLE), 6) FROM short) FROM fill
        UNION ALL SELECT 'name', 'one_hot', count(*), count(DISTINCT name), count(*)::DOUBLE FROM short""",
)
def empty_vocab_fallback(spark, folder):
    filler = F.when(F.col("c_nationkey") < 12, "you and them").otherwise("all those")
    short = table(spark, folder, "customer").select(
        "c_custkey", F.lower("c_mktsegment").alias("segment"), filler.alias("filler"), F.col("c_name").alias("name")
    )
    out = None
    for column in ("segment", "filler", "name"):
        branch, features = terms.fallback_features(short, "c_custkey", column)
        summary = features.agg(
            F.lit(column).alias("column"),
            F.lit(branch).alias("branch"),
            F.count("*").alias("n_values"),
            F.countDistinct("feature").alias("n_features"),
            F.round(F.sum("value"), 6).alias("total"),
        )
        out = summary if out is None else out.unionByName(summary)
    return out
