"""Nearest vectors, oversampling, clusters, recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from versemill.functions.parsing import parse_release_date, release_decade
from versemill.operators import clusters, joins, nearest, neighbors
from versemill.plans.registry import query, table
from versemill.plans.views import SONGS, VECTORS, songs, sql_hash, sql_unit, vectors

QUERY_ID = 8


def _embeddings(spark, folder):
    return table(spark, folder, "embeddings")


_COSINE = f"""cosine AS (SELECT e.*, CASE WHEN sqrt(list_sum(list_transform(e.embedding::DOUBLE[], lambda x: x * x))) * qn > 0
    THEN list_dot_product(e.embedding::DOUBLE[], q) / (sqrt(list_sum(list_transform(e.embedding::DOUBLE[], lambda x: x * x))) * qn) ELSE 0 END AS similarity
  FROM embeddings e, (SELECT embedding::DOUBLE[] AS q, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS qn
    FROM embeddings WHERE vec_id = {QUERY_ID}) WHERE e.vec_id <> {QUERY_ID})"""


@query("cosine_topn", f"WITH {_COSINE} SELECT vec_id, round(similarity, 6) AS similarity FROM cosine ORDER BY cosine.similarity DESC, vec_id LIMIT 10")
def cosine_topn(spark, folder):
    top = joins.cosine_topn(_embeddings(spark, folder), "vec_id", "embedding", QUERY_ID, 10)
    return top.select("vec_id", F.round("similarity", 6).alias("similarity"))


_DECADES = f"""{SONGS}, decades AS (SELECT doc_id, (coalesce(year(try_strptime(regexp_replace(release_date, '(\\d+)(st|nd|rd|th)', '\\1'), '%d %B %Y')), 0) // 10 * 10) || 's' AS decade FROM songs)"""


def _with_decade(spark, folder):
    decade = release_decade(parse_release_date(F.col("release_date")))
    known = songs(spark, folder).select(F.col("doc_id").alias("vec_id"), decade.alias("decade"))
    return _embeddings(spark, folder).join(known, "vec_id")


@query(
    "cosine_topn_constrained",
    f"""WITH {_COSINE}, {_DECADES}, here AS (SELECT label, decade FROM embeddings JOIN decades ON doc_id = vec_id WHERE vec_id = {QUERY_ID})
        SELECT vec_id, c.label, d.decade, round(similarity, 6) AS similarity FROM cosine c JOIN decades d ON doc_id = vec_id
        JOIN here ON here.label = c.label AND here.decade = d.decade ORDER BY c.similarity DESC, vec_id LIMIT 5""",
)
def cosine_topn_constrained(spark, folder):
    rows = _with_decade(spark, folder)
    top = joins.cosine_topn(rows, "vec_id", "embedding", QUERY_ID, 5, same=["label", "decade"])
    return top.select("vec_id", "label", "decade", F.round("similarity", 6).alias("similarity"))


def _sql_most_similar(rows: str, same: str) -> str:
    return f"""units AS (SELECT *, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS size FROM {rows}),
      pairs AS (SELECT a.vec_id, b.vec_id AS neighbour,
          round(CASE WHEN a.size * b.size > 0 THEN list_dot_product(a.v, b.v) / (a.size * b.size) ELSE 0 END, 9) + 0.0 AS exact
        FROM units a JOIN units b ON a.vec_id <> b.vec_id AND {same})
      SELECT vec_id, neighbour, round(exact, 6) AS similarity, row_number() OVER (PARTITION BY vec_id ORDER BY exact DESC, neighbour) AS place
      FROM pairs QUALIFY place <= 5"""


def _places(found):
    return found.select(F.col("id").alias("vec_id"), "neighbour", F.round("similarity", 6).alias("similarity"), F.col("place").cast("long").alias("place"))


@query(
    "cosine_topn_constrained_all",
    f"""WITH {_DECADES}, known AS (SELECT e.*, decade FROM embeddings e JOIN decades ON doc_id = vec_id),
        {_sql_most_similar('known', 'a.label = b.label AND a.decade = b.decade')}""",
)
def cosine_topn_constrained_all(spark, folder):
    return _places(nearest.most_similar(_with_decade(spark, folder), "vec_id", "embedding", 5, same=["label", "decade"]))


@query("cosine_topn_all", f"WITH {_sql_most_similar('embeddings', 'true')}")
def cosine_topn_all(spark, folder):
    return _places(nearest.most_similar(_embeddings(spark, folder), "vec_id", "embedding", 5))


@query(
    "recommendation_report",
    f"""WITH {_COSINE}, {SONGS}, top AS (SELECT vec_id, similarity FROM cosine ORDER BY cosine.similarity DESC, vec_id LIMIT 5)
        SELECT vec_id, song, artist, genre, round(similarity, 3) AS similarity FROM top JOIN songs ON doc_id = vec_id""",
)
def recommendation_report(spark, folder):
    top = joins.cosine_topn(_embeddings(spark, folder), "vec_id", "embedding", QUERY_ID, 5).select("vec_id", "similarity")
    return joins.recommendation_report(top, songs(spark, folder), "vec_id", "doc_id", ["song", "artist", "genre"])


_PAIRS = """pairs AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS distance
  FROM {source} a, {source} b WHERE a.vec_id <> b.vec_id),
  near AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) - 1 AS place FROM pairs QUALIFY place < 5)"""


_DIGEST = sql_hash(42, "number")


@query(
    "smote",
    f"""WITH {VECTORS}, minority AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS row FROM vectors WHERE toxic = 1),
        {_PAIRS.format(source='minority')},
        drawn AS (SELECT number, ('0x' || substr({_DIGEST}, 1, 8))::BIGINT % (SELECT count(*) FROM minority) AS row,
            ('0x' || substr({_DIGEST}, 9, 8))::BIGINT % 5 AS place, {sql_unit(_DIGEST, 17)} AS share
          FROM (SELECT unnest(range((SELECT count(*) FILTER (toxic = 0) - count(*) FILTER (toxic = 1) FROM vectors))) AS number)),
        made AS (SELECT number, share, s.embedding::DOUBLE[] AS a, e.embedding::DOUBLE[] AS b FROM drawn d JOIN minority s ON s.row = d.row
          JOIN near n ON n.id = s.vec_id AND n.place = d.place JOIN minority e ON e.vec_id = n.neighbour),
        long AS (SELECT number, share, generate_subscripts(a, 1) - 1 AS dim, unnest(a) AS x, unnest(b) AS y FROM made)
        SELECT 1 AS toxic, number, dim, round(x + share * (y - x), 6) AS value FROM long""",
)
def smote(spark, folder):
    made = neighbors.smote(vectors(spark, folder), "vec_id", "toxic", "embedding")
    return made.select("toxic", "number", F.posexplode("vec").alias("d", "v")).select(
        "toxic", "number", F.col("d").cast("bigint").alias("dim"), F.round("v", 6).alias("value")
    )


@query(
    "smote_balanced",
    f"""WITH {VECTORS} SELECT toxic, (SELECT greatest(count(*) FILTER (toxic = 0), count(*) FILTER (toxic = 1)) FROM vectors) AS n
        FROM vectors GROUP BY toxic""",
)
def smote_balanced(spark, folder):
    rows = vectors(spark, folder)
    made = neighbors.smote(rows, "vec_id", "toxic", "embedding")
    both = rows.select("toxic").unionByName(made.select("toxic"))
    return both.groupBy("toxic").agg(F.count("*").alias("n"))


_LONG = """long AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
  centre AS (SELECT label, dim, avg(x) AS m FROM long GROUP BY label, dim)"""


@query(
    "kmeans_assign",
    f"""WITH {_LONG}, d AS (SELECT vec_id, c.label, sum((x - m) * (x - m)) AS d FROM long l JOIN centre c USING (dim) GROUP BY vec_id, c.label)
        SELECT vec_id, min_by(label, (d, label)) AS cluster FROM d GROUP BY vec_id""",
)
def kmeans_assign(spark, folder):
    rows = _embeddings(spark, folder)
    return clusters.assign(rows, "embedding", clusters.centroid_table(rows, "label", "embedding")).select("vec_id", "cluster")


@query(
    "cluster_quality_ch_db",
    f"""WITH {_LONG}, own AS (SELECT vec_id, l.label, sum((x - m) * (x - m)) AS d2 FROM long l JOIN centre c ON c.dim = l.dim AND c.label = l.label GROUP BY ALL),
        s AS (SELECT label, count(*) AS n, sum(d2) AS w, avg(sqrt(d2)) AS spread FROM own GROUP BY label),
        overall AS (SELECT dim, avg(x) AS m FROM long GROUP BY dim),
        b AS (SELECT sum(n * (c.m - o.m) * (c.m - o.m)) AS b FROM centre c JOIN overall o USING (dim) JOIN s USING (label)),
        gap AS (SELECT a.label AS i, c.label AS j, sqrt(sum((a.m - c.m) * (a.m - c.m))) AS g FROM centre a JOIN centre c USING (dim) WHERE a.label <> c.label GROUP BY ALL),
        worst AS (SELECT i, max((si.spread + sj.spread) / g) AS r FROM gap JOIN s si ON si.label = i JOIN s sj ON sj.label = j GROUP BY i)
        SELECT round((SELECT b FROM b) / (count(*) - 1) / (sum(w) / (sum(n) - count(*))), 6) AS calinski_harabasz,
          round((SELECT avg(r) FROM worst), 6) AS davies_bouldin FROM s""",
)
def cluster_quality_ch_db(spark, folder):
    quality = clusters.quality(_embeddings(spark, folder), "label", "embedding")
    return quality.select(*[F.round(c, 6).alias(c) for c in quality.columns])


def _sql_silhouette(distance: str) -> str:
    return f"""WITH n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
      t AS (SELECT a.vec_id, a.label, b.label AS other, sum({distance}) AS total FROM embeddings a, embeddings b GROUP BY ALL),
      r AS (SELECT vec_id, max(n.n) FILTER (other = t.label) AS n_own, max(total / greatest(n.n - 1, 1)) FILTER (other = t.label) AS a,
          min(total / n.n) FILTER (other <> t.label) AS b FROM t JOIN n ON n.label = t.other GROUP BY vec_id)
      SELECT round(avg(CASE WHEN n_own > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette FROM r"""


_EUCLID = "list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@query("silhouette", _sql_silhouette(_EUCLID))
def silhouette(spark, folder):
    score = neighbors.silhouette(_embeddings(spark, folder), "vec_id", "embedding", "label")
    return score.select(F.round("silhouette", 6).alias("silhouette"))


@query("silhouette_squared", _sql_silhouette(f"{_EUCLID} * {_EUCLID}"))
def silhouette_squared(spark, folder):
    score = clusters.silhouette_squared(_embeddings(spark, folder), "vec_id", "embedding", "label")
    return score.select(F.round("silhouette", 6).alias("silhouette"))
