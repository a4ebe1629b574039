"""Views over the given tables: songs, votes, scored vectors, runs; in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from versemill.functions.scalars import hash_key, hash_unit
from versemill.functions.text import (
    DIGIT,
    NOT_WORD,
    SPACE,
    SPLIT_WORDS,
    URL,
    stopwords,
)
from versemill.plans.registry import table

MONTHS = (
    "January February March April May June July August September October November December"
).split()
MOODS = "joy sadness anger fear love".split()


def _months() -> Column:
    return F.array(*[F.lit(m) for m in MONTHS])


def songs(spark: SparkSession, folder: str) -> DataFrame:
    """documents ⟕ labels with song metadata made from the length of the text."""
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    n = F.col("n_chars")
    day = (n % 28 + 1).cast("int")
    suffix = (
        F.when(day.isin(11, 12, 13), "th")
        .when(day % 10 == 1, "st")
        .when(day % 10 == 2, "nd")
        .when(day % 10 == 3, "rd")
        .otherwise("th")
    )
    date = F.concat_ws(
        " ",
        F.concat(day.cast("string"), suffix),
        F.get(_months(), (n % 12).cast("int")),
        (1960 + n % 60).cast("string"),
    )
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        "text",
        "lang",
        F.concat(F.lit("Song "), F.col("doc_id").cast("string")).alias("song"),
        F.when(n % 31 != 0, F.concat(F.lit("Artist "), (n % 50).cast("string"))).alias("artist"),
        F.when(n % 17 != 0, F.col("source")).alias("genre"),
        F.when(n % 7 != 0, F.get(F.array(*map(F.lit, MOODS)), (n % 5).cast("int"))).alias("emotion"),
        F.when(F.col("toxic") == 1, F.when(n % 2 == 0, "Yes").otherwise("YES"))
        .when(F.col("toxic") == 0, "No")
        .alias("explicit"),
        F.when(n % 13 == 0, F.lit("n/a"))
        .when(n % 29 != 0, F.concat(F.lit("-"), (n % 60).cast("string"), F.lit("."), two(n % 100), F.lit("db")))
        .alias("loudness"),
        F.when(n % 23 != 0, F.concat(two(n % 12), F.lit(":"), two(n % 60))).alias("length"),
        F.when(n % 19 == 0, F.lit("unknown")).when(n % 37 != 0, date).alias("release_date"),
        F.when(n % 41 != 0, (n % 101).cast("int")).alias("popularity"),
        F.when(n % 43 != 0, (n % 1000) / F.lit(1000.0)).alias("energy"),
        (60 + n % 140).cast("double").alias("tempo"),
    )


_SQL_MONTHS = "[" + ",".join(f"'{m}'" for m in MONTHS) + "]"
_SQL_MOODS = "[" + ",".join(f"'{m}'" for m in MOODS) + "]"

SONGS = f"""songs AS (
  SELECT doc_id, text, lang, 'Song ' || doc_id AS song,
    CASE WHEN n % 31 <> 0 THEN 'Artist ' || (n % 50) END AS artist,
    CASE WHEN n % 17 <> 0 THEN source END AS genre,
    CASE WHEN n % 7 <> 0 THEN ({_SQL_MOODS})[n % 5 + 1] END AS emotion,
    CASE WHEN toxic = 1 THEN CASE WHEN n % 2 = 0 THEN 'Yes' ELSE 'YES' END
         WHEN toxic = 0 THEN 'No' END AS explicit,
    CASE WHEN n % 13 = 0 THEN 'n/a'
         WHEN n % 29 <> 0 THEN '-' || (n % 60) || '.' || lpad((n % 100)::VARCHAR, 2, '0') || 'db' END AS loudness,
    CASE WHEN n % 23 <> 0 THEN lpad((n % 12)::VARCHAR, 2, '0') || ':' || lpad((n % 60)::VARCHAR, 2, '0') END AS length,
    CASE WHEN n % 19 = 0 THEN 'unknown'
         WHEN n % 37 <> 0 THEN (n % 28 + 1) || (CASE
              WHEN n % 28 + 1 IN (11, 12, 13) THEN 'th' WHEN (n % 28 + 1) % 10 = 1 THEN 'st'
              WHEN (n % 28 + 1) % 10 = 2 THEN 'nd' WHEN (n % 28 + 1) % 10 = 3 THEN 'rd' ELSE 'th' END)
              || ' ' || ({_SQL_MONTHS})[n % 12 + 1] || ' ' || (1960 + n % 60) END AS release_date,
    CASE WHEN n % 41 <> 0 THEN (n % 101)::INTEGER END AS popularity,
    CASE WHEN n % 43 <> 0 THEN (n % 1000)::DOUBLE / 1000.0::DOUBLE END AS energy,
    (60 + n % 140)::DOUBLE AS tempo
  FROM (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars AS n, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
)"""


def votes(spark: SparkSession, folder: str) -> DataFrame:
    """Three sources of one label: the given one, a score, and a model's answer."""
    h = hash_key("votes", F.col("doc_id"))
    answer = hash_unit(h, 9, 8)
    return table(spark, folder, "labels").select(
        "doc_id",
        F.col("toxic").alias("label"),
        F.round(hash_unit(h, 1, 8) * 0.6 + F.col("toxic") * 0.35, 3).alias("score"),
        F.when(answer + F.col("toxic") * 0.5 >= 0.7, F.when(answer < 0.85, "Explicit").otherwise("explicit"))
        .otherwise("not explicit")
        .alias("answer"),
    )


def sql_unit(digest: str, start: int = 1, digits: int = 8) -> str:
    return f"(('0x' || substr({digest}, {start}, {digits}))::BIGINT / {float(16**digits)!r}::DOUBLE)"


def sql_hash(seed: int | str, *parts: str) -> str:
    return "md5('" + str(seed) + "' || " + " || ".join(f"':' || {p}" for p in parts) + ")"


VOTES = f"""votes AS (
  SELECT doc_id, toxic AS label,
    round({sql_unit(sql_hash('votes', 'doc_id'))} * 0.6::DOUBLE + toxic * 0.35::DOUBLE, 3) AS score,
    CASE WHEN {sql_unit(sql_hash('votes', 'doc_id'), 9)} + toxic * 0.5::DOUBLE >= 0.7::DOUBLE
         THEN CASE WHEN {sql_unit(sql_hash('votes', 'doc_id'), 9)} < 0.85::DOUBLE THEN 'Explicit' ELSE 'explicit' END
         ELSE 'not explicit' END AS answer
  FROM labels
)"""


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of hits and misses of several models on several data sets.

    Supplier = data set, line number = model, 'R' returns = predicted, open lines = actual.
    """
    predicted = F.col("l_returnflag") == "R"
    actual = F.col("l_linestatus") == "O"
    count = lambda c: F.sum(c.cast("int")).cast("bigint")
    return (
        table(spark, folder, "lineitem")
        .groupBy(
            F.col("l_suppkey").alias("dataset"),
            F.concat(F.lit("model_"), F.col("l_linenumber").cast("string")).alias("model"),
        )
        .agg(
            count(predicted & actual).alias("tp"),
            count(predicted & ~actual).alias("fp"),
            count(~predicted & actual).alias("fn"),
            count(~predicted & ~actual).alias("tn"),
        )
        .select(
            "dataset",
            "model",
            F.round((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")), 6).alias("accuracy"),
            F.round(F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0), 6).alias("f1"),
            # Whole percents make ties between models of one data set.
            F.expr("(fp + fn) * 100 div (tp + fp + fn + tn) / 100.0D").alias("error"),
        )
    )


RUNS = """runs AS (
  SELECT dataset, model, round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 6) AS accuracy,
    round(CASE WHEN tp > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0.0::DOUBLE END, 6) AS f1,
    ((fp + fn) * 100 // (tp + fp + fn + tn)) / 100.0::DOUBLE AS error
  FROM (SELECT l_suppkey AS dataset, 'model_' || l_linenumber AS model,
      (count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O'))::BIGINT AS tp,
      (count(*) FILTER (l_returnflag = 'R' AND l_linestatus <> 'O'))::BIGINT AS fp,
      (count(*) FILTER (l_returnflag <> 'R' AND l_linestatus = 'O'))::BIGINT AS fn,
      (count(*) FILTER (l_returnflag <> 'R' AND l_linestatus <> 'O'))::BIGINT AS tn
    FROM lineitem GROUP BY ALL)
)"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings with the binary label of the document of the same id."""
    emb = table(spark, folder, "embeddings")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("vec_id"), "toxic")
    return emb.join(labels, "vec_id")


VECTORS = """vectors AS (
  SELECT e.vec_id, e.embedding, e.label, l.toxic FROM embeddings e JOIN labels l ON l.doc_id = e.vec_id
)"""


def sql_clean(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    for pattern, put in [(URL, ""), (NOT_WORD, " "), (DIGIT, ""), (f"[{SPACE}]+", " ")]:
        out = f"regexp_replace({out}, '{pattern}', '{put}', 'g')"
    return f"trim({out})"


def sql_tokens(cleaned: str) -> str:
    cases = " ".join(f"WHEN '{a}{b}' THEN ['{a}', '{b}']" for a, b in SPLIT_WORDS)
    words = f"list_filter(string_split({cleaned}, ' '), lambda w: w <> '')"
    return f"flatten(list_transform({words}, lambda w: CASE w {cases} ELSE [w] END))"


def sql_stop_list(language: str = "english") -> str:
    return "(" + ", ".join(f"'{w}'" for w in stopwords(language)) + ")"


def sql_content(tokens: str, language: str = "english") -> str:
    """Tokens without stop words and short ones."""
    return f"list_filter({tokens}, lambda w: w NOT IN {sql_stop_list(language)} AND length(w) > 2)"


# Documents as content tokens, and the n-grams (1, 2) and the counts made from them.
TOKENS = f"""tokens AS (
  SELECT doc_id, {sql_content('raw')} AS words
  FROM (SELECT doc_id, {sql_tokens('cleaned')} AS raw
        FROM (SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents))
)"""

GRAMS = (
    TOKENS
    + """, grams AS (
  SELECT doc_id, unnest(list_concat(words,
    list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS term
  FROM tokens
), counts AS (
  SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL
)"""
)

WORD_COUNTS = (
    TOKENS
    + """, counts AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM tokens) GROUP BY ALL
)"""
)
