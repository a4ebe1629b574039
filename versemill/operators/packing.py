"""Batches of limited rows and bytes in the order of a loop, without a loop over the table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.operators.ranking import join_small
from versemill.session import cut_lineage

#: Rows of a range on average; a range is read by one task at a time, as two numbers a row.
RANGE_ROWS = 1_000_000


def next_starts(upto: np.ndarray, max_rows: int, max_bytes: int) -> np.ndarray:
    """For each row, the first row after it that a batch begun there does not take. `upto` has the
    bytes before each row, and all bytes at its end."""
    rows = np.arange(len(upto) - 1)
    by_bytes = np.searchsorted(upto, upto[:-1] + max_bytes, side="right") - 1
    return np.maximum(rows + 1, np.minimum(rows + max_rows, by_bytes))


def ways_through(size: np.ndarray, max_rows: int, max_bytes: int) -> dict[str, list[int]]:
    """What a range does to a batch that is open at its first row.

    Such a batch ends before one of the first max_rows rows. For each of these as first start, how
    many batches start in the range (`starts`) and where the last of them does (`last`); and the
    bytes before these rows (`before`), which say how far an open batch reaches.
    """
    m = len(size)
    upto = np.concatenate([[0], np.cumsum(size)])
    after = next_starts(upto, max_rows, max_bytes)
    # Pointers are doubled: the k-th of `hops` leads over 2 ** k batches.
    hops, jump = [], np.append(after, m).astype(np.int32)
    while (jump < m).any():
        hops.append(jump)
        jump = jump[jump]
    heads = min(m, max_rows)
    last, starts = np.arange(heads), np.ones(heads, np.int64)
    for k in reversed(range(len(hops))):
        inside = hops[k][last] < m
        last = np.where(inside, hops[k][last], last)
        starts += inside.astype(np.int64) << k
    numbers = {"starts": starts, "last": last, "upto_last": upto[last], "before": upto[: heads + 1]}
    return {"rows": [m], "bytes": [int(upto[-1])], **{k: v.tolist() for k, v in numbers.items()}}


def pack_greedy(df: DataFrame, id_col: str, bytes_col: str, max_rows: int, max_bytes: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All rows with `batch`, from 1: rows in the order of the id; a row opens the next batch if the
    open one has `max_rows` rows or would pass `max_bytes` with it. A row above `max_bytes` is a batch.

    Ids are unique; rows without one are left out. The table is cut into ranges of the id. Each range tells, for every place in which
    its first batch can start, where its last one does; the driver goes through the ranges by these
    tables (max_rows numbers a range), and then every range numbers its rows by itself.
    An absent size counts nothing.
    """
    plain = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(bytes_col).cast("long"), F.lit(0).cast("long")).alias("size"))
    n = max(1, -(-plain.count() // range_rows))
    ranged = cut_lineage(plain.repartitionByRange(n, "id").withColumn("part", F.spark_partition_id()))

    def summary(held: pa.Table) -> pa.Table:
        held = held.sort_by("id")
        found = ways_through(held.column("size").to_numpy(), max_rows, max_bytes)
        return pa.table({"part": held.column("part").slice(0, 1).combine_chunks(), **{k: pa.array([v], pa.list_(pa.int64())) for k, v in found.items()}})

    fields = "part int, rows array<long>, bytes array<long>, starts array<long>, last array<long>, upto_last array<long>, before array<long>"
    tables = ranged.groupBy("part").applyInArrow(summary, fields)
    # The open batch before each range: its number, rows and bytes.
    entries, number, rows, size = [], 0, max_rows, 0
    for t in tables.orderBy("part").toLocalIterator():
        m = t["rows"][0]
        most = min(max_rows - rows, m)
        fits = int(np.searchsorted(t["before"][: most + 1], max_bytes - size, side="right")) - 1
        first = max(0, min(most, fits))
        entries.append((t["part"], first, number))
        if first >= m:
            rows, size = rows + m, size + t["bytes"][0]
            continue
        number += t["starts"][first]
        rows, size = m - t["last"][first], t["bytes"][0] - t["upto_last"][first]
    entry = df.sparkSession.createDataFrame(entries, "part int, first long, number long")

    def mark(held: pa.Table) -> pa.Table:
        held = held.sort_by("id")
        after = next_starts(np.concatenate([[0], np.cumsum(held.column("size").to_numpy())]), max_rows, max_bytes)
        opens = np.zeros(len(after), np.int64)
        at = held.column("first")[0].as_py()
        while at < len(after):
            opens[at] = 1
            at = int(after[at])
        batch = held.column("number")[0].as_py() + np.cumsum(opens)
        return pa.table({"packed_id": held.column("id"), "batch": pa.array(batch, pa.int64())})

    of_id = plain.schema["id"].dataType.simpleString()
    batches = join_small(ranged, entry, ["part"]).groupBy("part").applyInArrow(mark, f"packed_id {of_id}, batch long")
    return df.drop("batch").join(batches, F.col(id_col) == F.col("packed_id")).drop("packed_id")
