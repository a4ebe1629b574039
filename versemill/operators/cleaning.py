"""Row cleaning and column profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from versemill.operators.ranking import number_by_id, running_totals, value_buckets

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.fill(0, subset=columns)


def fill_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.fill("unknown", subset=columns)


def drop_listed_rows(df: DataFrame, drop: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id is not listed, numbered again from 0 in `row_id`."""
    kept = df.join(drop.select(id_col), id_col, "left_anti")
    numbered = number_by_id(kept, id_col, "row_id")
    return numbered.withColumn("row_id", F.col("row_id") - 1)


def select_listed_rows(df: DataFrame, listed: DataFrame, id_col: str) -> DataFrame:
    """Rows named by a split list (`pos`, id), in the order of the list."""
    return df.join(listed, id_col).orderBy("pos")


def distinct_counts(df: DataFrame) -> DataFrame:
    """(column, is_numeric, n_distinct): one row per column, from one pass over the table.

    Every text cell is first cut to its distinct (column, value) pairs, so that no task has to
    hold all values of one column. Numeric columns are known from the schema alone.
    """
    schema = "column string, is_numeric boolean, n_distinct bigint"
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    texts = [c for c in df.columns if c not in numbers]
    out = df.sparkSession.createDataFrame([(c, True, None) for c in numbers], schema)
    if texts:
        # A long text is told apart by its digest, so that whole texts are not shuffled.
        short = lambda v: F.when(F.length(v) > 32, F.md5(v)).otherwise(v)
        cells = F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column"), short(F.col(c).cast("string")).alias("value")) for c in texts]
            )
        )
        distinct = df.select(cells.alias("cell")).select("cell.*").distinct()
        counted = distinct.groupBy("column").agg(F.count("value").alias("n_distinct"))
        out = out.unionByName(counted.withColumn("is_numeric", F.lit(False)))
    return out


def column_roles(df: DataFrame, tolerance: int) -> DataFrame:
    """Each column as numeric, categorical (few distinct texts) or textual."""
    role = (
        F.when(F.col("is_numeric"), "numeric")
        .when(F.col("n_distinct") < tolerance, "categorical")
        .otherwise("textual")
    )
    return distinct_counts(df).select("column", role.alias("role"))


def column_role_sweep(df: DataFrame, tolerances: list[int]) -> DataFrame:
    """Number of columns of each role for each tolerance."""
    limits = F.explode(F.array(*[F.lit(t) for t in tolerances]))
    few = F.col("n_distinct") < F.col("tolerance")
    count = lambda c: F.sum(c.cast("int")).cast("bigint")
    return (
        distinct_counts(df)
        .select("*", limits.alias("tolerance"))
        .groupBy("tolerance")
        .agg(
            count(~F.col("is_numeric") & few).alias("categorical"),
            count(~F.col("is_numeric") & ~few).alias("textual"),
            count(F.col("is_numeric")).alias("numeric"),
        )
    )


def numeric_columns(df: DataFrame) -> DataFrame:
    """Names of the columns whose values all read as numbers, from one pass."""
    counts = df.agg(
        *[F.count(c).alias(f"{c}_any") for c in df.columns],
        *[F.count(F.col(c).try_cast("double")).alias(f"{c}_num") for c in df.columns],
    )
    named = F.array(
        *[
            F.when(F.col(f"{c}_any") == F.col(f"{c}_num"), F.lit(c))
            for c in df.columns
        ]
    )
    return counts.select(F.explode(named).alias("name")).filter("name IS NOT NULL")


def schema_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Values of `name` on either side: only_expected, only_actual or both."""
    left = expected.select("name").distinct().withColumn("_l", F.lit(True))
    right = actual.select("name").distinct().withColumn("_r", F.lit(True))
    side = (
        F.when(F.col("_l").isNull(), "only_actual")
        .when(F.col("_r").isNull(), "only_expected")
        .otherwise("both")
    )
    return left.join(right, "name", "full").select("name", side.alias("side"))


def same_keys(left: DataFrame, right: DataFrame, pos: str, key: str) -> DataFrame:
    """Compare two key columns by position: one row with counts and `identical`."""
    both = left.select(pos, F.col(key).alias("_l")).join(
        right.select(pos, F.col(key).alias("_r")), pos, "full"
    )
    wrong = (~F.col("_l").eqNullSafe(F.col("_r"))).cast("int")
    return both.agg(
        F.count("*").alias("n_positions"),
        F.coalesce(F.sum(wrong), F.lit(0)).cast("bigint").alias("n_mismatch"),
    ).withColumn("identical", F.col("n_mismatch") == 0)


def pack_batches(
    df: DataFrame, id_col: str, bytes_col: str, max_rows: int, max_bytes: int
) -> DataFrame:
    """Add `batch`: rows in id order cut into batches of limited rows and bytes.

    A batch is one pair (row cell, byte cell), where the cells are the rows and bytes before
    the row divided by the limits. Both only grow, so a batch is one run of ids.
    """
    placed = running_totals(
        value_buckets(df, id_col),
        [],
        [id_col],
        {"_rows": F.lit(1).cast("bigint"), "_bytes": F.col(bytes_col).cast("bigint")},
    )
    celled = placed.withColumn("_row_cell", F.floor(F.col("_rows") / max_rows)).withColumn(
        "_byte_cell", F.floor(F.col("_bytes") / max_bytes)
    )
    # The cells alone are far fewer than the rows, and are numbered by their first row.
    firsts = celled.groupBy("_row_cell", "_byte_cell").agg(F.min("_rows").alias("_first"))
    numbered = number_by_id(firsts, "_first", "batch").drop("_first")
    return celled.join(numbered, ["_row_cell", "_byte_cell"]).drop(
        "_rows", "_bytes", "_row_cell", "_byte_cell"
    )
