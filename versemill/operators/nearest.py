"""The most similar rows of every row, within groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versemill.operators.ranking import join_small

#: Rows of a block on average. A task compares two blocks at once.
BLOCK_ROWS = 1000
#: A group is cut into MOST_BLOCKS at most, so that a row is moved no oftener, until its blocks have LARGE_ROWS rows.
MOST_BLOCKS, LARGE_ROWS = 24, 32_000
#: Similarities that a task holds at once.
CELLS = 4_000_000
#: Places that a similarity is rounded to before rows are ranked by it, so that equal vectors are ties.
PLACES = 9


def best_places(similarity: np.ndarray, n: int) -> np.ndarray:
    """Marks the n largest of each row; of equal ones, the first."""
    if similarity.shape[1] <= n:
        return np.isfinite(similarity)
    last = -np.partition(-similarity, n - 1, axis=1)[:, n - 1 : n]
    above, equal = similarity > last, similarity == last
    left = n - above.sum(axis=1, keepdims=True)
    return (above | (equal & (np.cumsum(equal, axis=1) <= left))) & np.isfinite(similarity)


def unit_rows(vectors: pa.Array, n: int) -> np.ndarray:
    x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def blocks_of(rows: Column, block_rows: int) -> Column:
    """How many blocks a group of so many rows is cut into."""
    large = max(LARGE_ROWS, block_rows)
    return F.greatest(F.least(F.ceil(rows / block_rows), F.lit(MOST_BLOCKS)), F.ceil(rows / large)).cast("long")


def most_similar(
    df: DataFrame, id_col: str, vec_col: str, n: int, same: list[str] | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(id, neighbour, similarity, place): the n rows most similar to each row, by cosine, without the
    row itself; place 1 is the best, ties go by id.

    Rows are compared if they are equal in all columns of `same`. Each group is cut into blocks by a
    digest of the id, as many as its rows need, and each pair of blocks is one product of matrices, in
    its own task if need be, that puts out n rows at most for each row of either block. So the work is
    that of all pairs of a group, and none of the pairs is a row. A row is moved as often as its group
    has blocks, which are MOST_BLOCKS at most below MOST_BLOCKS * LARGE_ROWS rows: so far what is moved
    grows as the rows do.

    Ids are whole numbers; rows of one id are one row's and not each other's neighbours. Rows without
    id, vector or group column are left out. A vector without length has similarity 0 to all. Vectors
    have one length.
    """
    named = {f"k{i}": F.col(c) for i, c in enumerate(same or [])}
    rows = df.select(*[c.alias(k) for k, c in named.items()], F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.dropna()
    keys = list(named)
    blocks = blocks_of(F.count("*"), block_rows).alias("blocks")
    if keys:
        sized = join_small(rows, rows.groupBy(*keys).agg(blocks), keys)
    else:
        sized = rows.withColumn("blocks", F.lit(rows.agg(blocks).head()["blocks"]))
    placed = sized.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    paired = placed.filter("blocks > 0").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = paired.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})

    def compare(held: pa.Table) -> pa.Table:
        held = held.combine_chunks().sort_by("id")
        ids = held.column("id").to_numpy()
        unit = unit_rows(held.column("vec").combine_chunks(), len(ids))
        first = np.asarray(held.column("block")) == np.asarray(held.column("lo"))
        sides = [(first, first)] if first.all() and held.column("lo")[0] == held.column("hi")[0] else [(first, ~first), (~first, first)]
        out = []
        for left, right in sides:
            if not left.any() or not right.any():
                continue
            a, b = ids[left], ids[right]
            step = max(1, CELLS // len(b))
            u, v = unit[left], unit[right].T
            for start in range(0, len(a), step):
                some = a[start : start + step]
                similarity = np.round(u[start : start + step] @ v, PLACES) + 0.0
                similarity[some[:, None] == b[None, :]] = -np.inf
                x, y = np.nonzero(best_places(similarity, n))
                out.append((some[x], b[y], similarity[x, y]))
        parts = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"id": pa.array(parts[0], pa.int64()), "neighbour": pa.array(parts[1], pa.int64()), "similarity": pa.array(parts[2], pa.float64())})

    found = paired.select(*keys, "id", "vec", "block", "lo", "hi").groupBy(*keys, "lo", "hi").applyInArrow(compare, "id long, neighbour long, similarity double")
    order = Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)
