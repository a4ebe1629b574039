"""What several operators share: words as bytes, keys of a learning split, passing columns through."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of characters other than the space and U+0009 to U+000D. On UTF-8 these are
#: the bytes at which `bytes.split()` splits, and `bytes.lower()` lowers A to Z alone.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; an absent id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor


def encoded(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; an absent text is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def pieces(texts: list[bytes], limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about `limit` bytes together (a longer text is a run of its own)."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def schema_with(df: DataFrame, fields: str) -> T.StructType:
    """The columns of `df` and then `fields`; columns of `df` with such a name must be gone."""
    return T.StructType([*df.schema.fields, *T._parse_datatype_string(fields).fields])


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop what would clash with new columns, however the letters are cased."""
    wanted = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in wanted])


def appended(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])
