"""Samples, splits, balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from versemill.operators import sampling
from versemill.plans.registry import query, table
from versemill.plans.views import sql_hash


def _labels(spark, folder):
    return table(spark, folder, "labels").select("doc_id", "toxic")


@query("sample_n", f"SELECT doc_id, n_chars FROM documents ORDER BY {sql_hash(42, 'doc_id')}, doc_id LIMIT 500")
def sample_n(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return sampling.sample_n(docs, "doc_id", 500, seed=42)


@query(
    "split_random",
    f"""SELECT vec_id, label, CASE WHEN row_number() OVER (ORDER BY {sql_hash(42, 'vec_id')}, vec_id)
          <= round(0.2::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END AS part FROM embeddings""",
)
def split_random(spark, folder):
    return sampling.split_random(table(spark, folder, "embeddings").select("vec_id", "label"), "vec_id")


STRATIFIED = f"""split AS (SELECT doc_id, toxic, CASE
    WHEN row_number() OVER (PARTITION BY toxic ORDER BY {sql_hash(42, 'doc_id')}, doc_id)
      <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY toxic)) THEN 'test' ELSE 'train' END AS part FROM labels)"""


@query("split_stratified", f"WITH {STRATIFIED} SELECT * FROM split")
def split_stratified(spark, folder):
    return sampling.split_stratified(_labels(spark, folder), "doc_id", "toxic")


_UNDER = """SELECT doc_id, toxic FROM (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {digest}, doc_id) AS rk
  FROM {source}) WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM {source} GROUP BY toxic))"""


@query("undersample", f"WITH {STRATIFIED}, train AS (SELECT doc_id, toxic FROM split WHERE part = 'train') " + _UNDER.format(digest=sql_hash(42, "doc_id"), source="train"))
def undersample(spark, folder):
    """Only the training part is balanced."""
    train = split_stratified(spark, folder).filter("part = 'train'").drop("part")
    return sampling.undersample(train, "doc_id", "toxic")


@query("balance_before_split", "SELECT * FROM (" + _UNDER.format(digest=sql_hash(42, "doc_id"), source="labels") + ")")
def balance_before_split(spark, folder):
    return sampling.undersample(_labels(spark, folder), "doc_id", "toxic")


@query(
    "kfold_stratified",
    f"""SELECT doc_id, toxic, ((row_number() OVER (PARTITION BY toxic ORDER BY {sql_hash(42, 'doc_id')}, doc_id) - 1) % 5)::INTEGER AS fold
        FROM labels""",
)
def kfold_stratified(spark, folder):
    return sampling.kfold_stratified(_labels(spark, folder), "doc_id", "toxic")


@query("union_train_test", f"WITH {STRATIFIED} SELECT doc_id, toxic FROM split")
def union_train_test(spark, folder):
    split = split_stratified(spark, folder)
    parts = [split.filter(F.col("part") == p).drop("part") for p in ("train", "test")]
    return parts[0].unionByName(parts[1])
