"""Incremental ingest: only new files are read, each batch is entered in a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema,
    target: str,
    id_col: str,
    files_per_batch: int = 1000,
) -> None:
    """Read the files that are new since the last call and append them to `target`.

    A batch is written to a folder of its own number, so a batch that is run again after a
    failure replaces its own output instead of adding to it.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/rows/batch={number}")
        written = spark.read.schema(batch.schema).parquet(f"{target}/rows/batch={number}")
        entry = written.agg(
            F.min(id_col).alias("start"),
            F.max(id_col).alias("end"),
            F.count("*").alias("n_rows"),
        ).withColumn("status", F.lit("completed"))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{target}/ledger/batch={number}")

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .writeStream.option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
    query.awaitTermination()


def ingested(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/rows")


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """(start, end, batch, status) and the number of rows, one row per batch."""
    return spark.read.parquet(f"{target}/ledger")
