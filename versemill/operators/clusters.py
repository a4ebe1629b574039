"""Clusters given as a column: centroids, assignment, quality.

What is known of the clusters is a table of one row a cluster. Rows meet it in blocks: a block is
one row that holds BLOCK clusters as an array, so every row compares itself with all clusters in
the row, without copies of rows, whatever the number of clusters.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from versemill.functions.vectors import dot, squared_distance
from versemill.operators.ranking import join_small

BLOCK = 500


def centroid_table(df: DataFrame, cluster: str, vec_col: str) -> DataFrame:
    """(cluster, centre): the mean vector of each cluster, whatever their number."""
    long = df.select(cluster, F.posexplode(F.col(vec_col).cast("array<double>")).alias("dim", "x"))
    means = long.groupBy(cluster, "dim").agg(F.avg("x").alias("mean"))
    held = F.sort_array(F.collect_list(F.struct("dim", "mean")))
    return means.groupBy(cluster).agg(F.transform(held, lambda p: p["mean"]).alias("centre"))


def _blocks(table: DataFrame) -> Iterator[DataFrame]:
    """One-row frames of BLOCK rows of a table by cluster, as the array `_block`."""
    schema = T.StructType([T.StructField("_block", T.ArrayType(table.schema))])
    held = []
    for row in table.orderBy(table.columns[0]).toLocalIterator():
        held.append(row)
        if len(held) == BLOCK:
            yield table.sparkSession.createDataFrame([(held,)], schema)
            held = []
    if held:
        yield table.sparkSession.createDataFrame([(held,)], schema)


def assign(df: DataFrame, vec_col: str, centres: DataFrame, out: str = "cluster") -> DataFrame:
    """Number of the nearest of the (cluster, centre) rows; ties go to the smaller number."""
    name = centres.columns[0]
    near = df.withColumn("_near", F.lit(None).cast(f"struct<d: double, c: {dict(centres.dtypes)[name]}>"))
    for block in _blocks(centres):
        distances = F.transform("_block", lambda b: F.struct(squared_distance(F.col(vec_col), b["centre"]).alias("d"), b[name].alias("c")))
        near = near.crossJoin(F.broadcast(block)).withColumn("_near", F.least("_near", F.array_min(distances))).drop("_block")
    return near.withColumn(out, F.col("_near.c")).drop("_near")


def quality(df: DataFrame, cluster: str, vec_col: str) -> DataFrame:
    """Calinski-Harabasz and Davies-Bouldin indices: one row.

    The rows are read twice (means, distances to them). The second index compares every two
    clusters, which is done on one centre and one spread per cluster.
    """
    rows = df.select(F.col(cluster).alias("c"), F.col(vec_col).alias("v"))
    gap = squared_distance(F.col("v"), F.col("centre"))
    near = join_small(rows, centroid_table(rows, "c", "v"), ["c"]).select("c", "centre", gap.alias("d2"))
    stats = near.groupBy("c").agg(
        F.first("centre").alias("centre"), F.avg(F.sqrt("d2")).alias("spread"), F.count("*").alias("n"), F.sum("d2").alias("within")
    )
    # Between the clusters: the sum of n (m - overall)², subtracted before it is squared.
    long = stats.select("n", F.posexplode("centre").alias("dim", "m"))
    n, m = F.col("n"), F.col("m")
    overall = long.groupBy("dim").agg((F.sum(n * m) / F.sum(n)).alias("overall"))
    gap = m - F.col("overall")
    between = join_small(long, overall, ["dim"]).agg(F.sum(n * gap * gap).alias("between"))
    worst = stats.withColumn("_worst", F.lit(None).cast("double"))
    for block in _blocks(stats.select("c", "centre", "spread")):
        others = F.filter("_block", lambda b: b["c"] != F.col("c"))
        ratio = F.transform(others, lambda b: (F.col("spread") + b["spread"]) / F.sqrt(squared_distance(F.col("centre"), b["centre"])))
        worst = worst.crossJoin(F.broadcast(block)).withColumn("_worst", F.greatest("_worst", F.array_max(ratio))).drop("_block")
    sums = worst.agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("within").alias("within"), F.avg("_worst").alias("davies_bouldin")
    )
    ch = F.col("between") / (F.col("k") - 1) / (F.col("within") / (F.col("n") - F.col("k")))
    return sums.crossJoin(between).select(ch.alias("calinski_harabasz"), "davies_bouldin")


def silhouette_squared(df: DataFrame, id_col: str, vec_col: str, cluster: str) -> DataFrame:
    """Mean silhouette with squared distances, worked out in each row.

    The sum of squared distances to a cluster follows from its size, its vector sum and its sum
    of squared lengths. Vectors are taken from their overall mean first, as squares of values far
    from zero would lose the digits of the distances.
    """
    given = df.select(F.col(cluster).cast("int").alias("c"), F.col(vec_col).cast("array<double>").alias("v"))
    middle = centroid_table(given.withColumn("c", F.lit(0)), "c", "v").select(F.col("centre").alias("_middle"))
    rows = given.crossJoin(F.broadcast(middle)).select("c", F.zip_with("v", "_middle", lambda x, m: x - m).alias("v"))
    rows = rows.withColumn("q", dot(F.col("v"), F.col("v")))
    sizes = rows.groupBy("c").agg(F.count("*").alias("n"), F.sum("q").alias("q"))
    table = join_small(centroid_table(rows, "c", "v"), sizes, ["c"])
    scored = rows.withColumns({name: F.lit(None).cast("double") for name in ("a", "b", "n_own")})

    def total(b: Column) -> Column:
        return b["n"] * F.col("q") - 2 * b["n"] * dot(F.col("v"), b["centre"]) + b["q"]

    for block in _blocks(table):
        own = F.filter("_block", lambda b: b["c"] == F.col("c"))
        others = F.filter("_block", lambda b: b["c"] != F.col("c"))
        mean_own = F.transform(own, lambda b: total(b) / F.greatest(b["n"] - 1, F.lit(1)))
        mean_other = F.transform(others, lambda b: total(b) / b["n"])
        scored = scored.crossJoin(F.broadcast(block)).withColumns(
            {
                "a": F.coalesce("a", F.array_max(mean_own)),
                "b": F.least("b", F.array_min(mean_other)),
                "n_own": F.coalesce("n_own", F.array_max(F.transform(own, lambda b: b["n"].cast("double")))),
            }
        ).drop("_block")
    most = F.greatest("a", "b")
    score = F.when((F.col("n_own") > 1) & (most > 0), (F.col("b") - F.col("a")) / most).otherwise(0.0)
    return scored.agg(F.avg(score).alias("silhouette"))
