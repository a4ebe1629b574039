"""Sources and sinks: what is written is read back and must equal the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from versemill.functions.scalars import hash_key, hash_unit
from versemill.operators import joins, metrics
from versemill.plans.registry import query, table
from versemill.plans.views import VOTES, sql_hash, sql_unit, votes
from versemill.session import work_folder
from versemill.sources import files
from versemill.streaming.ingest import ingest_new_files, ingested, ledger


@query("src_csv", "SELECT doc_id, text, lang, n_chars FROM documents")
def src_csv(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "n_chars")
    path = work_folder(spark, "csv")
    files.write_csv(docs, path)
    return files.read_csv(spark, path, docs.schema)


@query("src_head", "SELECT doc_id, text, n_chars FROM documents ORDER BY doc_id LIMIT 1000")
def src_head(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    return files.head_rows(docs, "doc_id", 1000)


@query("src_row_range", "SELECT doc_id, text FROM documents WHERE doc_id >= 100 AND doc_id < 600")
def src_row_range(spark, folder):
    return files.row_range(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", 100, 600)


@query(
    "src_embedding",
    """SELECT vec_id, d.lang, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS value
       FROM embeddings JOIN documents d ON d.doc_id = vec_id""",
)
def src_embedding(spark, folder):
    emb = table(spark, folder, "embeddings").select("vec_id", "embedding")
    rows = table(spark, folder, "documents").select("doc_id", "lang")
    same = F.col("doc_id") == F.col("vec_id")
    known, held = rows.join(emb.select("vec_id"), same, "left_semi"), emb.join(rows.select("doc_id"), same, "left_semi")
    both = files.align_vectors(known, held, "doc_id", "vec_id")
    return both.select("vec_id", "lang", F.posexplode(F.col("embedding").cast("array<double>")).alias("d", "value")).select(
        "vec_id", "lang", F.col("d").cast("bigint").alias("dim"), "value"
    )


@query(
    "src_embedding_lacking",
    """SELECT coalesce(doc_id, vec_id) AS id, CASE WHEN vec_id IS NULL THEN 'vector' ELSE 'row' END AS lacks
       FROM documents FULL JOIN embeddings ON doc_id = vec_id WHERE doc_id IS NULL OR vec_id IS NULL""",
)
def src_embedding_lacking(spark, folder):
    return files.lacking_partners(table(spark, folder, "documents"), table(spark, folder, "embeddings"), "doc_id", "vec_id")


@query(
    "src_jsonl_response",
    """SELECT vec_id AS id, generate_subscripts(embedding, 1) - 1 AS dim, round(unnest(embedding)::DOUBLE, 6) AS value
       FROM embeddings""",
)
def src_jsonl_response(spark, folder):
    path = work_folder(spark, "responses")
    emb = table(spark, folder, "embeddings")
    vec = F.col("embedding").cast("array<double>")
    files.write_responses(emb.withColumn("embedding", vec), "vec_id", "embedding", path)
    good, _ = files.read_responses(spark, path)
    return good.select("id", F.posexplode("embedding").alias("d", "v")).select(
        "id", F.col("d").cast("bigint").alias("dim"), F.round("v", 6).alias("value")
    )


_WORD_VECTORS = """SELECT 'song_' || vec_id AS key, generate_subscripts(embedding, 1) - 1 AS dim,
       round(unnest(embedding)::DOUBLE, 6) AS value FROM embeddings"""


def _word_vectors(spark, folder):
    path = work_folder(spark, "word-vectors")
    emb = table(spark, folder, "embeddings").select(
        F.concat(F.lit("song_"), F.col("vec_id").cast("string")).alias("key"), "embedding"
    )
    files.write_word_vectors(emb, "key", "embedding", path)
    return path


@query("src_word2vec_text", _WORD_VECTORS)
def src_word2vec_text(spark, folder):
    path = _word_vectors(spark, folder)
    back = files.read_word_vectors(spark, f"{path}/header", f"{path}/rows")
    return back.select("key", F.posexplode("vector").alias("d", "v")).select(
        "key", F.col("d").cast("bigint").alias("dim"), F.round("v", 6).alias("value")
    )


@query(
    "snk_word2vec_text",
    "SELECT count(*) || ' ' || max(len(embedding)) AS header, count(*) AS n_lines FROM embeddings",
)
def snk_word2vec_text(spark, folder):
    path = _word_vectors(spark, folder)
    n = spark.read.text(f"{path}/rows").agg(F.count("*")).scalar()
    return spark.read.text(f"{path}/header").select(F.col("value").alias("header"), n.alias("n_lines"))


@query("src_index_list", "SELECT doc_id AS id FROM labels WHERE toxic = 1")
def src_index_list(spark, folder):
    path = work_folder(spark, "id-list")
    listed = table(spark, folder, "labels").filter("toxic = 1")
    files.write_id_list(listed, "doc_id", path)
    return files.read_id_list(spark, path)


@query("snk_predictions", f"WITH {VOTES} SELECT doc_id AS row_id, score, (score >= 0.5)::INTEGER AS pred FROM votes")
def snk_predictions(spark, folder):
    path = work_folder(spark, "predictions")
    pred = (F.col("score") >= 0.5).cast("int")
    votes(spark, folder).select(F.col("doc_id").alias("row_id"), "score", pred.alias("pred")).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "snk_request_jsonl",
    f"""SELECT 'request-' || doc_id AS custom_id, 'POST' AS method, '{files.REQUEST_URL}' AS url,
          '{files.REQUEST_MODEL}' AS model, text AS input FROM documents""",
)
def snk_request_jsonl(spark, folder):
    path = work_folder(spark, "requests")
    files.write_requests(table(spark, folder, "documents"), "doc_id", "text", path)
    schema = "custom_id string, method string, url string, body struct<model: string, input: string>"
    return spark.read.schema(schema).json(path).select("custom_id", "method", "url", "body.model", "body.input")


@query(
    "snk_metrics",
    f"""WITH {VOTES}, c AS (SELECT count(*) FILTER (label = 1 AND p) AS tp, count(*) FILTER (label = 0 AND p) AS fp,
            count(*) FILTER (label = 1 AND NOT p) AS fn, count(*) AS n, count(*) FILTER ((label = 1) = p) AS hit
          FROM (SELECT label, score >= 0.5 AS p FROM votes))
        SELECT 'votes' AS feature_set, 'score' AS model, metric, value FROM (
          SELECT 'accuracy' AS metric, round(hit / n, 6) AS value FROM c
          UNION ALL SELECT 'precision', round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) FROM c
          UNION ALL SELECT 'recall', round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) FROM c
          UNION ALL SELECT 'f1', round(CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) FROM c)""",
)
def snk_metrics(spark, folder):
    path = work_folder(spark, "metrics")
    scored = votes(spark, folder).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    long = metrics.long_metrics(metrics.binary_metrics(scored, "label", "pred"), ["accuracy", "precision", "recall", "f1"])
    named = long.select(F.lit("votes").alias("feature_set"), F.lit("score").alias("model"), "metric", F.round("value", 6).alias("value"))
    named.write.json(path)
    return spark.read.schema(named.schema).json(path)


@query("incremental_ingest", "SELECT doc_id, text, lang, n_chars, 0::BIGINT AS added_by_rerun FROM documents")
def incremental_ingest(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "n_chars")
    source, target = work_folder(spark, "arrivals"), work_folder(spark, "ingested")
    docs.repartition(8, "doc_id").write.parquet(source)
    for _ in range(2):
        before = _rows(spark, target)
        ingest_new_files(spark, source, docs.schema, target, "doc_id", files_per_batch=4)
        added = _rows(spark, target) - before
    return ingested(spark, target).drop("batch").withColumn("added_by_rerun", F.lit(added).cast("bigint"))


def _rows(spark, target):
    try:
        return ledger(spark, target).agg(F.sum("n_rows")).head()[0]
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return 0


@query("missing_ids", "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)")
def missing_ids(spark, folder):
    docs = table(spark, folder, "documents").agg(F.min("doc_id"), F.max("doc_id")).head()
    return joins.missing_ids(table(spark, folder, "embeddings"), "vec_id", docs[0], docs[1])


@query(
    "reprocess_missing",
    "SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)",
)
def reprocess_missing(spark, folder):
    return joins.listed_rows(table(spark, folder, "documents").select("doc_id", "text"), missing_ids(spark, folder), "doc_id", "id")


@query(
    "fuse_batches",
    "SELECT row_number() OVER (ORDER BY vec_id) AS rn, vec_id, round(list_sum(embedding)::DOUBLE, 4) AS total FROM embeddings",
)
def fuse_batches(spark, folder):
    """Batches written apart (by hash), read together and put in id order."""
    emb = table(spark, folder, "embeddings").select("vec_id", "embedding")
    part = F.floor(hash_unit(hash_key(1, F.col("vec_id"))) * 4).cast("int")
    path = work_folder(spark, "batches")
    emb.withColumn("part", part).write.partitionBy("part").parquet(path)
    fused = joins.fuse_batches(spark, path, "vec_id")
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return fused.select("rn", "vec_id", F.round(total, 4).alias("total"))


@query(
    "split_persist_reuse",
    f"""SELECT doc_id, n_chars, CASE WHEN {sql_unit(sql_hash(7, 'doc_id'))} < 0.2 THEN 'test' ELSE 'train' END AS part
        FROM documents JOIN labels USING (doc_id)""",
)
def split_persist_reuse(spark, folder):
    """Split ids are written as CSV by one job and used by another."""
    ids = table(spark, folder, "labels").select("doc_id")
    is_test = hash_unit(hash_key(7, F.col("doc_id"))) < 0.2
    path = work_folder(spark, "split")
    for part, keep in (("train", ~is_test), ("test", is_test)):
        files.write_csv(ids.filter(keep).withColumnRenamed("doc_id", f"{part}_index"), f"{path}/{part}")
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    back = [
        docs.join(files.read_split_ids(spark, f"{path}/{part}", f"{part}_index"), F.col("doc_id") == F.col(f"{part}_index"))
        .select("doc_id", "n_chars", F.lit(part).alias("part"))
        for part in ("train", "test")
    ]
    return back[0].unionByName(back[1])
