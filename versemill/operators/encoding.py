"""Categories and numbers as features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.functions.scalars import hash_int
from versemill.operators.ranking import join_small, number_by_id, number_sorted
from versemill.session import cut_lineage


def feature_names(columns: list[str]) -> Column:
    """array of `column=value` for the columns that have a value."""
    named = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in columns]
    return F.array_compact(F.array(*named))


def indicators(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id, feature): one row for each value present."""
    return df.select(id_col, F.explode(feature_names(columns)).alias("feature"))


def one_hot(train: DataFrame, rows: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id, feature, value = 1) of `rows` for the categories of `train`; others give no row."""
    known = train.select(F.explode(feature_names(columns)).alias("feature")).distinct()
    held = join_small(indicators(rows, id_col, columns), known, ["feature"])
    return held.select(id_col, "feature", F.lit(1.0).alias("value"))


def with_flags(train: DataFrame, rows: DataFrame, column: str, out: str) -> DataFrame:
    """`rows` with a 0/1 array over the sorted categories that `column` has in `train`.

    The codes are a table joined by value, however many; the array has a place for each.
    """
    found = train.select(F.col(column).alias(column)).filter(F.col(column).isNotNull()).distinct()
    codes = cut_lineage(number_sorted(found, column, "_code"))
    places = F.sequence(F.lit(1), F.lit(codes.count()).cast("long")) if not codes.isEmpty() else F.array().cast("array<bigint>")
    coded = join_small(rows, codes, [column], "left")
    flags = F.transform(places, lambda i: F.coalesce((i == F.col("_code")).cast("int"), F.lit(0)))
    return coded.withColumn(out, flags).drop("_code")


def dummies_align(train: DataFrame, rows: DataFrame, id_col: str, column: str) -> DataFrame:
    """(id, indicators) of `rows` with exactly the categories of `train`."""
    return with_flags(train, rows, column, "indicators").select(id_col, "indicators")


def feature_hash(df: DataFrame, id_col: str, columns: list[str], buckets: int = 2048) -> DataFrame:
    """(id, bucket, value): `column=value` put into a fixed number of buckets by digest."""
    bucket = F.transform(feature_names(columns), lambda f: hash_int(F.md5(f)) % buckets)
    placed = df.select(id_col, F.array_sort(bucket).alias("b"))
    # A handful of features per row: the equal buckets of a row are counted in the row.
    distinct = F.transform(
        F.array_distinct("b"),
        lambda x: F.struct(
            x.alias("bucket"),
            F.aggregate("b", F.lit(0.0), lambda s, y: s + F.when(y == x, 1.0).otherwise(0.0)).alias("value"),
        ),
    )
    return placed.select(id_col, F.explode_outer(distinct).alias("f")).select(id_col, "f.*")


def ordinal_codes(df: DataFrame, id_col: str, column: str) -> DataFrame:
    """(value, code): codes 0, 1, 2 … in the order in which values first appear."""
    first = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.min(id_col).alias("_first"))
    return number_by_id(first, "_first", "code").select(column, (F.col("code") - 1).alias("code"))


def ordinal_encode(df: DataFrame, id_col: str, column: str) -> DataFrame:
    return join_small(df, ordinal_codes(df, id_col, column), [column], "left")


def _one_row(train: DataFrame, measures: dict[str, Column]):
    return train.agg(*[m.alias(name) for name, m in measures.items()]).head()


def minmax_apply(train: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Scale by the minimum and maximum of `train`, without clipping; a constant column gives
    its distance from the constant."""
    fit = _one_row(
        train,
        {f"{c}_min": F.min(F.col(c).cast("double")) for c in columns}
        | {f"{c}_max": F.max(F.col(c).cast("double")) for c in columns},
    )
    scaled = {}
    for c in columns:
        low, high = fit[f"{c}_min"], fit[f"{c}_max"]
        width = (high - low) or 1.0
        scaled[c] = (F.col(c) - F.lit(low)) / F.lit(width)
    return rows.withColumns(scaled)


def standardize(train: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """(x − mean) / population deviation; a constant column gives 0."""
    fit = _one_row(
        train,
        {f"{c}_mean": F.avg(c) for c in columns} | {f"{c}_std": F.stddev_pop(c) for c in columns},
    )
    scaled = {
        c: (F.col(c) - F.lit(fit[f"{c}_mean"])) / F.lit(fit[f"{c}_std"] or 1.0) for c in columns
    }
    return rows.withColumns(scaled)


def concat_features(*blocks: Column) -> Column:
    """One array<double> from numeric columns and arrays, in the given order."""
    return F.concat(*[b.cast("array<double>") for b in blocks])


def mean_pool(df: DataFrame, group: str, vec_col: str, mask: Column) -> DataFrame:
    """(group, dim, value): mean of the vectors whose mask is 1, by group and position.

    Partial sums leave each task, one per group and position.
    """
    long = df.select(group, mask.cast("double").alias("_m"), F.posexplode(vec_col).alias("dim", "_x"))
    return long.groupBy(group, "dim").agg(
        (F.sum(F.col("_m") * F.col("_x").cast("double")) / F.greatest(F.sum("_m"), F.lit(1e-9))).alias("value")
    )
