"""Readers and writers of the file formats: CSV, JSON lines, word vectors, id lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One embedding request, and one line of a response file.
REQUEST_METHOD = "POST"
REQUEST_URL = "/v1/embeddings"
REQUEST_MODEL = "text-embedding-3-small"
RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("custom_id", T.StringType()),
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField(
                        "body",
                        T.StructType(
                            [
                                T.StructField(
                                    "data",
                                    T.ArrayType(
                                        T.StructType(
                                            [T.StructField("embedding", T.ArrayType(T.DoubleType()))]
                                        )
                                    ),
                                )
                            ]
                        ),
                    )
                ]
            ),
        ),
    ]
)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Delimited files with a header and quoted text over several lines.

    A file with such text cannot be split, so large inputs should come as many files.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def head_rows(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """First n rows by id (a top-n per partition, then one merge)."""
    return df.orderBy(id_col).limit(n)


def row_range(df: DataFrame, id_col: str, start: int, end: int) -> DataFrame:
    """Rows with start ≤ id < end; the range reaches the Parquet row groups."""
    return df.filter((F.col(id_col) >= start) & (F.col(id_col) < end))


def lacking_partners(rows: DataFrame, vectors: DataFrame, row_id: str, vec_id: str) -> DataFrame:
    """(id, lacks): ids of one side that the other does not have; lacks is `vector` or `row`."""
    left = rows.select(F.col(row_id).alias("id")).distinct().withColumn("_row", F.lit(1))
    right = vectors.select(F.col(vec_id).alias("id")).distinct().withColumn("_vec", F.lit(1))
    lacks = F.when(F.col("_vec").isNull(), "vector").when(F.col("_row").isNull(), "row")
    return left.join(right, "id", "full").select("id", lacks.alias("lacks")).filter("lacks IS NOT NULL")


def align_vectors(rows: DataFrame, vectors: DataFrame, row_id: str, vec_id: str) -> DataFrame:
    """Rows with their vectors; raises when the two sides do not have the same ids."""
    found = lacking_partners(rows, vectors, row_id, vec_id).groupBy("lacks").agg(F.count("*").alias("n")).collect()
    lacking = {r["lacks"]: r["n"] for r in found}
    if lacking:
        raise ValueError(f"{lacking.get('vector', 0)} rows without a vector, {lacking.get('row', 0)} vectors without a row")
    return rows.join(vectors, F.col(row_id) == F.col(vec_id))


def write_requests(df: DataFrame, id_col: str, text_col: str, path: str) -> None:
    """One JSON request per row."""
    request_lines(df, id_col, text_col).write.text(path)


def request_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = F.struct(F.lit(REQUEST_MODEL).alias("model"), F.col(text_col).alias("input"))
    request = F.struct(
        F.concat(F.lit("request-"), F.col(id_col).cast("string")).alias("custom_id"),
        F.lit(REQUEST_METHOD).alias("method"),
        F.lit(REQUEST_URL).alias("url"),
        body.alias("body"),
    )
    return df.select(F.to_json(request).alias("value"))


def write_responses(df: DataFrame, id_col: str, vec_col: str, path: str) -> None:
    """Response files as the embedding service returns them."""
    one = F.struct(F.col(vec_col).alias("embedding"))
    line = F.struct(
        F.concat(F.lit("request-"), F.col(id_col).cast("string")).alias("custom_id"),
        F.struct(F.struct(F.array(one).alias("data")).alias("body")).alias("response"),
    )
    df.select(F.to_json(line).alias("value")).write.text(path)


def read_responses(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(id and vector of each good line, the rejected lines); blank lines are skipped."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", RESPONSE_SCHEMA).alias("r")).select(
        "value",
        F.regexp_extract("r.custom_id", r"(\d+)", 1).try_cast("bigint").alias("id"),
        F.get(F.col("r.response.body.data"), F.lit(0))["embedding"].alias("embedding"),
    )
    good = F.col("id").isNotNull() & F.col("embedding").isNotNull()
    return parsed.filter(good).select("id", "embedding"), parsed.filter(~good).select("value")


def write_word_vectors(df: DataFrame, key: str, vec: str, path: str) -> None:
    """`n dim` in its own header file, then one `key v1 … vd` line per row."""
    numbers = F.array_join(F.transform(vec, lambda x: x.cast("double").cast("string")), " ")
    df.select(F.concat_ws(" ", key, numbers).alias("value")).write.text(f"{path}/rows")
    header = df.agg(F.count("*").alias("n"), F.max(F.size(vec)).alias("dim"))
    header.select(F.concat_ws(" ", "n", "dim").alias("value")).write.text(f"{path}/header")


def read_word_vectors(spark: SparkSession, *paths: str) -> DataFrame:
    """(key, vector) of `key v1 … vd` lines; a line of two numbers is the header."""
    parts = F.split("value", " ")
    return (
        spark.read.text(list(paths))
        .filter((F.trim("value") != "") & ~F.col("value").rlike(r"^\d+ \d+$"))
        .select(
            F.get(parts, F.lit(0)).alias("key"),
            F.transform(
                F.slice(parts, F.lit(2), F.size(parts) - 1), lambda x: x.cast("double")
            ).alias("vector"),
        )
    )


def write_id_list(df: DataFrame, id_col: str, path: str) -> None:
    """Id list as JSON arrays, one per task, so that no task holds the whole list."""
    packed = df.select(F.col(id_col).alias("id")).groupBy(
        F.expr("floor(id / 10000)").alias("part")
    ).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    packed.select(F.to_json("ids").alias("value")).write.text(path)


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids of files that hold JSON arrays of integers; split at commas, so a long array
    on one line is still read by many tasks."""
    numbers = F.regexp_extract_all("value", F.lit(r"(-?\d+)"))
    return (
        spark.read.option("lineSep", ",")
        .text(path)
        .select(F.explode(numbers).alias("id"))
        .select(F.col("id").cast("bigint"))
    )


def read_split_ids(spark: SparkSession, path: str, column: str) -> DataFrame:
    return spark.read.schema(f"{column} bigint").option("header", True).csv(path)
