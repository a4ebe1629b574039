"""Equi-joins on row ids, gap finding, and nearest vectors of one query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versemill.functions.vectors import cosine
from versemill.operators.ranking import number_by_id


def align_predictions(truth: DataFrame, sources: dict[str, DataFrame], key: str) -> DataFrame:
    """Truth with one column per prediction source; ids absent from a source drop out.

    Each source is (key, value). The joins share one key, hence one partitioning.
    """
    out = truth
    for name, source in sources.items():
        out = out.join(source.select(key, F.col(source.columns[-1]).alias(name)), key)
    return out


def disagreement_rows(df: DataFrame, score: str, other: str, threshold: float = 0.5) -> DataFrame:
    predicted = (F.col(score) >= threshold).cast("int")
    return df.filter(predicted != F.col(other))


def missing_ids(df: DataFrame, id_col: str, start: int, end: int) -> DataFrame:
    """Ids of start..end (inclusive) that the table does not have."""
    expected = df.sparkSession.range(start, end + 1)
    return expected.join(df.select(F.col(id_col).alias("id")), "id", "left_anti")


def listed_rows(df: DataFrame, listed: DataFrame, id_col: str, list_col: str) -> DataFrame:
    return df.join(listed, F.col(id_col) == F.col(list_col), "left_semi")


def fuse_batches(spark: SparkSession, path: str, id_col: str) -> DataFrame:
    """All batch files as one table with its position by id."""
    return number_by_id(spark.read.parquet(path), id_col)


def cosine_topn(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    query_id: int,
    n: int,
    same: list[str] | None = None,
) -> DataFrame:
    """The n rows most similar to one row, without that row itself; ties by id.

    `same` names columns in which the rows must equal the query row. Only that one row comes
    to the driver; every partition keeps its own n best rows, so only those are moved.
    """
    same = same or []
    asked = df.filter(F.col(id_col) == query_id).select(vec_col, *same).head()
    if asked is None:
        raise ValueError(f"no row with {id_col} = {query_id}")
    others = df.filter(F.col(id_col) != query_id)
    for column in same:
        others = others.filter(F.col(column) == F.lit(asked[column]))
    vector = F.array(*[F.lit(float(x)) for x in asked[vec_col]])
    scored = others.withColumn("similarity", cosine(F.col(vec_col), vector))
    return scored.orderBy(F.desc("similarity"), id_col).limit(n)


def recommendation_report(
    top: DataFrame, songs: DataFrame, id_col: str, song_id: str, columns: list[str]
) -> DataFrame:
    """Song metadata of the top rows; the top table is limited, so it is the small side."""
    joined = songs.select(song_id, *columns).join(F.broadcast(top), F.col(song_id) == F.col(id_col))
    return joined.select(id_col, *columns, F.round("similarity", 3).alias("similarity"))
