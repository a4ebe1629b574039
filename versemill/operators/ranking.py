"""Order without a single-task window.

Row numbers, running totals and "the first q rows of each group" are computed per
(group, bucket); the totals of the buckets give the offsets. Buckets are slices of the
sort key, so a group that holds most of the rows is still spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versemill.session import cut_lineage

HASH_DIGITS = 3
#: Parts that the values of a column are counted by in one pass of a selection by rank.
CELLS = 4096


def join_small(df: DataFrame, side: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a summary by key; adaptive execution broadcasts it if its measured bytes allow.

    An absent key matches an absent key, so rows without a group stay in the result.
    """
    keys = {c: f"_on_{c}" for c in on}
    side = side.withColumnsRenamed(keys)
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()))
    return df.join(side, same, how).drop(*keys.values())


def bucket_count(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(16, 2 * partitions)


def value_buckets(df: DataFrame, column: str, out: str = "_bucket") -> DataFrame:
    """Add a bucket number that grows with `column`, cut at approximate quantiles."""
    return many_value_buckets(df, {column: out})


def many_value_buckets(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The same for several columns (column → name of its bucket), from one pass."""
    n = bucket_count(df)
    shares = [i / n for i in range(1, n)]
    named = [
        F.percentile_approx(F.col(c).cast("double"), shares, 20 * n).alias(out)
        for c, out in columns.items()
    ]
    cuts = df.agg(*named).head()
    splits = []
    for out in columns.values():
        inner = sorted(set(cuts[out] or [])) or [0.0]
        splits.append([-float("inf"), *inner, float("inf")])
    raw = {f"_raw_{out}": F.col(c).cast("double") for c, out in columns.items()}
    bucketizer = Bucketizer(
        splitsArray=splits,
        inputCols=list(raw),
        outputCols=list(columns.values()),
        handleInvalid="keep",
    )
    bucketed = bucketizer.transform(df.withColumns(raw)).drop(*raw)
    return bucketed.withColumns({out: F.col(out).cast("int") for out in columns.values()})


def cell_of(x: Column, intervals: list[tuple[float, float]], k: int) -> Column:
    """Which of the k equal parts of which interval x lies in, numbered in their order; null outside."""
    out = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(intervals):
        # Half of everything where the width itself is too large for a double.
        share = (x - lo) / (hi - lo) if math.isfinite(hi - lo) else (x / 2 - lo / 2) / (hi / 2 - lo / 2)
        place = i * k + F.least(F.floor(share * k), F.lit(k - 1)).cast("int")
        out = F.when(x.between(lo, hi), place).otherwise(out)
    return out


def values_at_ranks(named: DataFrame, wanted: Callable[[int], list[int]]) -> dict[str, tuple[int, dict[int, float]]]:
    """For each double column that has values: how many, and those at the ranks that `wanted` gives
    for this number (from 0, in rising order). Absent values are left out, NaN comes last.

    Selection by histograms: the rows are counted by CELLS parts of the range of values; only parts
    that hold a wanted rank are looked into again, from their least to their greatest value, until
    these are equal. A pass reads the table and moves CELLS counts a column and task at most, however
    many different values there are; numbers spread evenly take a pass for every two digits or so.
    """
    endless = (float("-inf"), float("inf"), float("nan"))
    first = []
    for i, name in enumerate(named.columns):
        x = F.col(f"`{name}`")
        finite = F.when(~x.isin(*endless), x)
        counts = [F.count_if(x == F.lit(e)).alias(f"e{i}_{j}") for j, e in enumerate(endless)]
        first += [F.count(x).alias(f"n{i}"), F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}"), *counts]
    row = named.agg(*first).head()
    out, at_once, todo, open_ = {}, {}, {}, {}
    for i, name in enumerate(named.columns):
        n, low, high, absent = row[f"n{i}"], row[f"e{i}_0"], row[f"e{i}_1"], row[f"e{i}_2"]
        if not n:
            continue
        at_once[i], todo[i] = {}, []
        out[name] = n, at_once[i]
        for rank in sorted(set(wanted(n))):
            if rank < low:
                at_once[i][rank] = endless[0]
            elif rank >= n - absent:
                at_once[i][rank] = endless[2]
            elif rank >= n - absent - high:
                at_once[i][rank] = endless[1]
            elif row[f"lo{i}"] == row[f"hi{i}"]:
                at_once[i][rank] = row[f"lo{i}"]
            else:
                todo[i].append(rank)
        if todo[i]:
            open_[i] = [(row[f"lo{i}"], row[f"hi{i}"], low)]
    while open_:
        parts = {i: max(2, CELLS // len(held)) for i, held in open_.items()}
        cells = []
        for i, held in open_.items():
            x = F.col(f"`{named.columns[i]}`")
            cells.append(F.struct(F.lit(i).alias("i"), cell_of(x, [h[:2] for h in held], parts[i]).alias("cell"), x.alias("x")))
        counted = named.select(F.explode(F.array(*cells)).alias("c")).select("c.*").filter("cell IS NOT NULL").groupBy("i", "cell")
        found = counted.agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
        going = {i: [] for i in open_}
        below = {(i, j): h[2] for i, held in open_.items() for j, h in enumerate(held)}
        for r in sorted(found, key=lambda r: (r["i"], r["cell"])):
            i, j = r["i"], r["cell"] // parts[r["i"]]
            start = below[i, j]
            below[i, j] = start + r["n"]
            inside = [rank for rank in todo[i] if start <= rank < start + r["n"]]
            if inside and r["lo"] == r["hi"]:
                at_once[i].update(dict.fromkeys(inside, r["lo"]))
            elif inside:
                going[i].append((r["lo"], r["hi"], start))
        todo = {i: [rank for rank in ranks if rank not in at_once[i]] for i, ranks in todo.items()}
        open_ = {i: held for i, held in going.items() if held}
    return out


def exact_percentiles(
    df: DataFrame, columns: dict[str, Column], shares: list[float]
) -> dict[str, list[float]]:
    """Interpolated percentiles of several columns, two ranks a share; columns without values are left out."""
    named = df.select(*[x.cast("double").alias(name) for name, x in columns.items()])
    found = values_at_ranks(named, lambda n: [rank for s in shares for rank in (int(s * (n - 1)), min(int(s * (n - 1)) + 1, n - 1))])
    out = {}
    for name, (n, at) in found.items():
        points = []
        for s in shares:
            low = int(s * (n - 1))
            a, b = at[low], at[min(low + 1, n - 1)]
            points.append(a if a == b else a + (s * (n - 1) - low) * (b - a))
        out[name] = points
    return out


def hash_buckets(df: DataFrame, digest: str, out: str = "_bucket") -> DataFrame:
    """Bucket of a uniform hex digest: its first digits."""
    return df.withColumn(out, F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("int"))


def running_totals(
    df: DataFrame, groups: list[str], order: list[str], totals: dict[str, Column]
) -> DataFrame:
    """For each name in `totals`, the sum over earlier rows of the group (exclusive).

    `df` carries `_bucket`, which must not decrease along `order`.
    """
    held = [F.sum(value).alias(f"_sum_{name}") for name, value in totals.items()]
    by_bucket = df.groupBy(*groups, "_bucket").agg(*held)
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = by_bucket.select(
        *groups,
        "_bucket",
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_from_{name}")
            for name in totals
        ],
    )
    within = (
        Window.partitionBy(*groups, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    out = join_small(df, offsets, [*groups, "_bucket"])
    for name, value in totals.items():
        local = F.coalesce(F.sum(value).over(within), F.lit(0))
        out = out.withColumn(name, F.col(f"_from_{name}") + local)
    return out.drop("_bucket", *[f"_from_{name}" for name in totals])


def row_numbers(
    df: DataFrame, groups: list[str], order: list[str], out: str = "rn"
) -> DataFrame:
    """1, 2, 3 … within each group along `order` (`df` carries `_bucket`)."""
    numbered = running_totals(df, groups, order, {out: F.lit(1).cast("bigint")})
    return numbered.withColumn(out, F.col(out) + 1)


def number_by_id(df: DataFrame, id_col: str, out: str = "rn") -> DataFrame:
    return row_numbers(value_buckets(df, id_col), [], [id_col], out)


def number_sorted(df: DataFrame, column: str, out: str = "rn") -> DataFrame:
    """1, 2, 3 … along `column`, which has one row a value of any type; absent values come last.

    Rows are put into ranges of the column and numbered there; the ranges' row counts (one row a
    partition) give the offsets.
    """
    order = F.col(column).asc_nulls_last()
    ranged = cut_lineage(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_part").alias("_of"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(order)
    numbered = ranged.join(offsets, F.col("_part") == F.col("_of"))
    return numbered.withColumn(out, F.col("_before") + F.row_number().over(inside)).drop("_part", "_of", "_before")


def take_first(
    df: DataFrame,
    groups: list[str],
    digest: str,
    id_col: str,
    quota: Callable[[Column], Column],
    out: str = "taken",
) -> DataFrame:
    """Flag the first `quota(n)` rows of each group in digest order.

    Only rows of the bucket in which the cut falls are sorted; all others are decided by
    their bucket alone, so the table itself is not shuffled.
    """
    bucketed = hash_buckets(df, digest)
    counts = bucketed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    all_of = Window.partitionBy(*groups)
    upto = all_of.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sized = counts.select(
        *groups,
        "_bucket",
        F.sum("_n").over(upto).alias("_upto"),
        "_n",
        quota(F.sum("_n").over(all_of)).cast("bigint").alias("_quota"),
    )
    # One row per group: the first bucket that reaches the quota, and how many it gives.
    reached = F.col("_upto") >= F.col("_quota")
    cut = sized.groupBy(*groups).agg(
        F.min(F.when(reached, F.struct("_bucket", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_left")))).alias("_cut")
    )
    cut = cut.select(*groups, F.col("_cut._bucket").alias("_cut_bucket"), F.col("_cut._left").alias("_left"))
    if groups:
        joined = join_small(bucketed, cut, groups)
    else:
        row = cut.head()
        joined = bucketed.withColumn("_cut_bucket", F.lit(row["_cut_bucket"]).cast("int"))
        joined = joined.withColumn("_left", F.lit(row["_left"]).cast("bigint"))
    # A quota above the group size takes everything.
    decided = joined.filter(
        F.col("_cut_bucket").isNull() | (F.col("_bucket") != F.col("_cut_bucket"))
    ).withColumn(
        out, F.col("_cut_bucket").isNull() | (F.col("_bucket") < F.col("_cut_bucket"))
    )
    edge = joined.filter(F.col("_bucket") == F.col("_cut_bucket"))
    order = Window.partitionBy(*groups, "_bucket").orderBy(digest, id_col)
    edge = edge.withColumn(out, F.row_number().over(order) <= F.col("_left"))
    return decided.unionByName(edge).drop("_bucket", "_cut_bucket", "_left")
