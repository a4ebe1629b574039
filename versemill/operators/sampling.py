"""Samples, splits, balancing. Random order is the order of a seeded digest of the row id,
so the result depends neither on partitions nor on a rerun of a lost task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.functions.scalars import hash_key
from versemill.operators.ranking import hash_buckets, row_numbers, take_first

DIGEST = "_digest"


def _digested(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    return df.withColumn(DIGEST, hash_key(seed, F.col(id_col)))


def smallest_digests(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """A few random rows: a top-n by digest."""
    return _digested(df, id_col, seed).orderBy(DIGEST, id_col).limit(n).drop(DIGEST)


def sample_n(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """n random rows (all when there are fewer), for any n."""
    flagged = take_first(_digested(df, id_col, seed), [], DIGEST, id_col, lambda _: F.lit(n))
    return flagged.filter("taken").drop(DIGEST, "taken")


def _test_rows(share: float):
    return lambda n: F.round(n * share)


def _split(df: DataFrame, groups: list[str], id_col: str, share: float, seed: int) -> DataFrame:
    flagged = take_first(_digested(df, id_col, seed), groups, DIGEST, id_col, _test_rows(share))
    part = F.when(F.col("taken"), "test").otherwise("train")
    return flagged.withColumn("part", part).drop(DIGEST, "taken")


def split_random(df: DataFrame, id_col: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add `part`: round(share · n) rows are test, the others train."""
    return _split(df, [], id_col, share, seed)


def split_stratified(
    df: DataFrame, id_col: str, label: str, share: float = 0.2, seed: int = 42
) -> DataFrame:
    """The same within each class, so that both parts keep the class shares."""
    return _split(df, [label], id_col, share, seed)


def undersample(df: DataFrame, id_col: str, label: str, seed: int = 42) -> DataFrame:
    """Every class cut to the size of the smallest one."""
    least = df.groupBy(label).count().agg(F.min("count")).head()[0]
    if least is None:
        return df
    flagged = take_first(_digested(df, id_col, seed), [label], DIGEST, id_col, lambda _: F.lit(least))
    return flagged.filter("taken").drop(DIGEST, "taken")


def kfold_stratified(
    df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Add a fold 0..k-1 such that each class is spread evenly over the folds."""
    bucketed = hash_buckets(_digested(df, id_col, seed), DIGEST)
    ranked = row_numbers(bucketed, [label], [DIGEST, id_col], "_rank")
    return ranked.withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop(DIGEST, "_rank")
