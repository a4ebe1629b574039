"""Exact nearest neighbours and exact silhouettes in blocks of bounded size.

A task compares one block of queries with one block of rows as matrices and gives back only
the k best per query (or one sum per query and cluster), never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.functions.scalars import hash_int, hash_key, hash_unit
from versemill.functions.vectors import interpolate
from versemill.operators.nearest import blocks_of
from versemill.operators.ranking import join_small, number_by_id
from versemill.session import cut_lineage

BLOCK_ROWS = 2048
MOST_CELLS = 2048
CHUNK = 32
#: Distances that a task holds at once, the share of the lengths below which they come from differences, and how many of these at once.
CELLS, NEAR, EXACT_ROWS = 2_000_000, 1e-6, 50_000


def _distances(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Euclidean distances by differences, some rows of `left` at a time."""
    for start in range(0, len(left), CHUNK):
        part = slice(start, start + CHUNK)
        gaps = left[part, None, :] - right[None, :, :]
        yield part, np.sqrt((gaps * gaps).sum(axis=2))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


def _blocks(count: Column, rows: int) -> Column:
    return F.greatest(F.ceil(count / rows), F.lit(1)).cast("int")


def _slice_of(id_col: str, salt: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), F.col(id_col)), blocks).cast("int")


def _search(queries: DataFrame, rows: DataFrame, sizes: DataFrame, k: int, block: int) -> DataFrame:
    """The k best rows of each (query, cell): (qid, id, distance), up to k per block of rows.

    `queries` is (qid, qvec, cell), `rows` (id, vec, cell), `sizes` (cell, n). A cell of any
    size is cut into blocks of rows, and its queries into blocks of queries.
    """
    asked = queries.groupBy("cell").agg(F.count("*").alias("n_asked"))
    grid = sizes.join(asked, "cell").select(
        "cell", _blocks(F.col("n"), block).alias("subs"), _blocks(F.col("n_asked"), block).alias("chunks")
    )
    left = join_small(queries, grid, ["cell"]).select(
        "qid", "qvec", "cell", _slice_of("qid", "q", F.col("chunks")).alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"),
    )
    right = join_small(rows, grid, ["cell"]).select(
        "id", "vec", F.col("cell").alias("row_cell"), _slice_of("id", "r", F.col("subs")).alias("sub"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )

    def best(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(r):
            r = r.sort_values("id")
            ids, qids = r["id"].to_numpy(), q["qid"].to_numpy()
            for part, distance in _distances(_matrix(q["qvec"]), _matrix(r["vec"])):
                distance[qids[part, None] == ids[None, :]] = np.inf
                # Rows stand in id order, so a stable sort breaks ties by id.
                order = np.argsort(distance, axis=1, kind="stable")[:, :k]
                held = np.take_along_axis(distance, order, axis=1)
                out.append(
                    pd.DataFrame(
                        {"qid": np.repeat(qids[part], order.shape[1]), "id": ids[order].ravel(), "distance": held.ravel()}
                    )
                )
        found = pd.concat(out) if out else pd.DataFrame({"qid": [], "id": [], "distance": []})
        return found[np.isfinite(found["distance"].to_numpy(dtype=float))]

    asking, answering = left.groupBy("cell", "sub", "chunk"), right.groupBy("row_cell", "sub", "chunk")
    return asking.cogroup(answering).applyInPandas(
        best, "qid bigint, id bigint, distance double"
    )


def _merge(found: DataFrame, k: int) -> DataFrame:
    """(qid, best): the k best of all blocks as a sorted array<struct<distance, id>>."""
    held = F.sort_array(F.collect_list(F.struct("distance", "id")))
    return found.groupBy("qid").agg(F.slice(held, 1, k).alias("best"))


def nearest(df: DataFrame, id_col: str, vec_col: str, k: int, block: int = BLOCK_ROWS) -> DataFrame:
    """(id, place, neighbour, distance): the k nearest other rows, exact, ties by id.

    Rows belong to the cell of the nearest of some pivot rows. Each query first searches its
    own cell; its k-th distance then rules out, by the triangle inequality, most cells, and
    only the others are searched too.
    """
    points = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    n = points.count()
    n_cells = max(1, min(MOST_CELLS, -(-n // block)))
    chosen = points.orderBy(hash_key("pivot", F.col("id"))).limit(n_cells).collect()
    if not chosen:
        return points.select("id", F.lit(0).alias("place"), F.col("id").alias("neighbour"), F.lit(0.0).alias("distance"))
    pivots = np.array([r["vec"] for r in chosen])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = _matrix(batch["vec"])
            cell, gap = np.empty(len(batch), dtype=np.int32), np.empty(len(batch))
            for part, distance in _distances(vectors, pivots):
                cell[part], gap[part] = distance.argmin(axis=1), distance.min(axis=1)
            yield batch.assign(cell=cell, gap=gap)

    placed = cut_lineage(points.mapInPandas(place, "id bigint, vec array<double>, cell int, gap double"))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius"))
    cells = {r["cell"]: r["radius"] for r in sizes.collect()}
    rows = placed.select("id", "vec", "cell")
    own = rows.select(F.col("id").alias("qid"), F.col("vec").alias("qvec"), "cell")
    first = cut_lineage(_merge(_search(own, rows, sizes.select("cell", "n"), k, block), k))
    if len(cells) > 1:
        reach = F.when(F.size("best") >= k, F.get("best", F.lit(k - 1))["distance"]).otherwise(F.lit(float("inf")))
        bounded = own.join(first.select("qid", reach.alias("reach")), "qid", "left").na.fill(float("inf"), ["reach"])
        numbers = np.array(sorted(cells))
        radii = np.array([cells[c] for c in numbers])

        def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for part, distance in _distances(_matrix(batch["qvec"]), pivots[numbers]):
                    held = batch.iloc[part]
                    near = distance - radii[None, :] <= held["reach"].to_numpy()[:, None] * (1 + 1e-9) + 1e-9
                    near &= held["cell"].to_numpy()[:, None] != numbers[None, :]
                    row, column = np.nonzero(near)
                    yield pd.DataFrame(
                        {"qid": held["qid"].to_numpy()[row], "qvec": held["qvec"].to_numpy()[row], "cell": numbers[column]}
                    )

        further = bounded.mapInPandas(others, "qid bigint, qvec array<double>, cell int")
        second = _search(further, rows, sizes.select("cell", "n"), k, block)
        again = first.select("qid", F.explode("best").alias("b")).select("qid", "b.id", "b.distance")
        first = _merge(again.unionByName(second), k)
    return first.select("qid", F.posexplode("best").alias("place", "b")).select(
        F.col("qid").alias("id"), "place", F.col("b.id").alias("neighbour"), F.col("b.distance").alias("distance")
    )


def smote(
    df: DataFrame, id_col: str, label: str, vec_col: str, k: int = 5, seed: int = 42
) -> DataFrame:
    """(label, number, vec): the new rows that bring every class to the size of the largest.

    New row j starts at a row of its class and goes a share of the way to one of its k nearest
    rows of the class; row, neighbour and share come from the digest of `seed:j`.
    """
    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    most = max(sizes.values(), default=0)
    out = None
    for value, size in sorted(sizes.items()):
        if size == most or size < 2:
            continue
        members = df.filter(F.col(label) == value).select(
            F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")
        )
        near = nearest(members, "id", "vec", min(k, size - 1))
        digest = hash_key(seed, F.col("number"))
        drawn = df.sparkSession.range(most - size).withColumnRenamed("id", "number").select(
            "number",
            (hash_int(digest, 1) % size).alias("row"),
            (hash_int(digest, 9) % min(k, size - 1)).cast("int").alias("place"),
            hash_unit(digest, 17).alias("share"),
        )
        starts = number_by_id(members, "id", "row").withColumn("row", F.col("row") - 1)
        ends = members.select(F.col("id").alias("neighbour"), F.col("vec").alias("end"))
        made = (
            drawn.join(starts, "row")
            .join(near.select("id", "place", "neighbour"), ["id", "place"])
            .join(ends, "neighbour")
            .select(F.lit(value).alias(label), "number", interpolate(F.col("vec"), F.col("end"), F.col("share")).alias("vec"))
        )
        out = made if out is None else out.unionByName(made)
    if out is None:
        out = df.limit(0).select(label, F.lit(0).cast("bigint").alias("number"), F.col(vec_col).cast("array<double>").alias("vec"))
    return out


def _product_distances(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Euclidean distances from a product of matrices, some rows of `left` at a time. What is near
    for its lengths, where the product loses digits, is worked out from differences."""
    centre = right.mean(axis=0)
    left, right = left - centre, right - centre
    a, b = (left * left).sum(axis=1), (right * right).sum(axis=1)
    step = max(1, CELLS // len(right))
    for start in range(0, len(left), step):
        part = slice(start, start + step)
        lengths = a[part, None] + b[None, :]
        squared = lengths - 2 * (left[part] @ right.T)
        x, y = np.nonzero(squared <= NEAR * lengths)
        for i in range(0, len(x), EXACT_ROWS):
            some, other = x[i : i + EXACT_ROWS], y[i : i + EXACT_ROWS]
            gaps = left[start + some] - right[other]
            squared[some, other] = (gaps * gaps).sum(axis=1)
        yield part, np.sqrt(squared, out=squared)


def cluster_distances(df: DataFrame, id_col: str, vec_col: str, cluster: str, block: int = BLOCK_ROWS) -> DataFrame:
    """(id, cluster of the row, other, total): sum of distances from a row to each cluster.

    Every two blocks meet once; a task holds two blocks and returns one sum per row and cluster.
    This is quadratic work, as the Euclidean silhouette is by definition. A row is moved as often
    as there are blocks, which grow with the rows (`blocks_of`).
    """
    points = df.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.col(cluster).cast("int").alias("c")
    )
    blocks = F.lit(points.agg(F.greatest(blocks_of(F.count("*"), block), F.lit(1))).head()[0])
    placed = points.withColumn("block", _slice_of("id", "b", blocks))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
    paired = paired.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})

    def member(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names, at = np.unique(c, return_inverse=True)
        return names, np.eye(len(names))[at]

    def sums(held: pa.Table) -> pa.Table:
        held = held.combine_chunks()
        ids, c = held.column("id").to_numpy(), held.column("c").to_numpy()
        vectors = held.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        first = held.column("block").to_numpy() == held.column("lo").to_numpy()
        left = np.flatnonzero(first)
        alone = held.column("lo")[0] == held.column("hi")[0]
        right = left if alone else np.flatnonzero(~first)
        out = []
        if len(left) and len(right):
            names, of_right = member(c[right])
            others, of_left = member(c[left])
            back = np.zeros((len(right), len(others)))
            for part, distance in _product_distances(vectors[left], vectors[right]):
                out.append((left[part], names, distance @ of_right))
                if not alone:
                    back += distance.T @ of_left[part]
            if not alone:
                out.append((right, others, back))
        parts = [(np.repeat(ids[at], len(n)), np.repeat(c[at], len(n)), np.tile(n, len(at)), total.ravel()) for at, n, total in out]
        columns = [np.concatenate(x) for x in zip(*parts)] or [np.zeros(0)] * 4
        kinds = {"id": pa.int64(), "c": pa.int32(), "other": pa.int32(), "total": pa.float64()}
        return pa.table({name: pa.array(column.astype(kind.to_pandas_dtype())) for (name, kind), column in zip(kinds.items(), columns)})

    parts = paired.select("id", "c", "vec", "block", "lo", "hi").groupBy("lo", "hi").applyInArrow(sums, "id bigint, c int, other int, total double")
    return parts.groupBy("id", "c", "other").agg(F.sum("total").alias("total"))


def silhouette_of(distances: DataFrame, sizes: DataFrame) -> DataFrame:
    """Mean silhouette from (id, c, other, total) and (other, n); a cluster of one gives 0."""
    own = F.col("other") == F.col("c")
    per_row = join_small(distances, sizes, ["other"]).groupBy("id").agg(
        F.max(F.when(own, F.col("n"))).alias("n_own"),
        F.max(F.when(own, F.col("total") / F.greatest(F.col("n") - 1, F.lit(1)))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    score = F.when((F.col("n_own") > 1) & (F.greatest("a", "b") > 0), (F.col("b") - F.col("a")) / F.greatest("a", "b")).otherwise(0.0)
    return per_row.agg(F.avg(score).alias("silhouette"))


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    return df.groupBy(F.col(cluster).cast("int").alias("other")).agg(F.count("*").alias("n"))


def silhouette(df: DataFrame, id_col: str, vec_col: str, cluster: str, block: int = BLOCK_ROWS) -> DataFrame:
    """Mean silhouette with Euclidean distance, exact."""
    return silhouette_of(cluster_distances(df, id_col, vec_col, cluster, block), cluster_sizes(df, cluster))
