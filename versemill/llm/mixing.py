"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Every document has a fixed digest of its id. Tokens are summed by source and leading digits of
the digest; per source the bucket in which the budget ends is found from the running sums, and
only documents of that bucket are summed again by the next digits, until the digits are used up.
The threshold that results is one value per source, so the documents are filtered without being
sorted or shuffled.

Defined cases: an absent or empty text has size 0 and takes 0; an absent source is a source, the
last; an absent id counts as empty text; rows of one digest in a source are decided together, so
repeated rows of one id are all taken or all left (whichever is nearer to the target); no rows
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from versemill.llm.common import WORD, without
from versemill.session import cut_lineage

#: Hexadecimal digits a level; LEVELS * DIGITS digits of the digest are used.
DIGITS = 3
LEVELS = 5
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)


def digest(id_col: str) -> Column:
    return F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, DIGITS * LEVELS)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def numbered_sources(sizes: DataFrame) -> DataFrame:
    """Adds `position`, 0 for the first source by code point, an absent one last.

    Sources are put into ranges and numbered within them; the ranges' row counts (as many as
    there are partitions) give the offsets, so no task sees all sources.
    """
    ranged = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    ranged = cut_lineage(ranged)  # the ranges are drawn by sampling: make them once
    offsets = ranged.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = offsets.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    return (
        ranged.join(offsets, "_part")
        .withColumn("position", F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_part", "_before")
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Every source gets level * weight but at most `most` times its size. The level rises while the
    excess of the capped sources is shared among the others; it changes at most once a source.
    """
    cycle = F.array(*map(F.lit, weights))
    weighted = numbered_sources(sizes).withColumn(
        "weight", F.element_at(cycle, (F.col("position") % len(weights) + 1).cast("int"))
    )
    weighted = cut_lineage(weighted)
    room = F.col("source_size") * most
    level = 0.0
    while True:
        capped = room < F.lit(level) * F.col("weight")
        row = weighted.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(capped, room).otherwise(0)).alias("full"),
            F.sum(F.when(~capped, F.col("weight")).otherwise(0)).alias("open"),
        ).head()
        if not row["all"] or not row["open"]:
            break
        new = (row["all"] - row["full"]) / row["open"]
        if new <= level:
            break
        level = new
    target = F.least(room.cast("double"), F.lit(float(level)) * F.col("weight"))
    return weighted.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, upto): every document is taken `whole` times, and once
    more if its digest is at most `upto`.

    `sized` has (source, digest, size). Each level sums DIGITS more digits, and only for rows in
    the bucket in which the budget of their source ends.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = wanted.withColumn("whole", F.least(whole, F.lit(MOST_REPEATS)).cast("long")).withColumns(
        {"left": F.col("target") - F.col("whole") * F.col("source_size"), "prefix": F.lit("")}
    )
    for step in range(1, LEVELS + 1):
        digits = step * DIGITS
        state = cut_lineage(state)
        key = state.select(F.col("source").alias("_s"), F.col("prefix").alias("_p"))
        same = F.col("source").eqNullSafe(F.col("_s")) & (F.substring("digest", 1, digits - DIGITS) == F.col("_p"))
        inside = sized.join(key, same) if step > 1 else sized
        bucket = F.substring("digest", 1, digits).alias("bucket")
        sums = inside.groupBy("source", bucket).agg(F.sum("size").alias("tokens"))
        # At most 16^DIGITS buckets a source are left here, whatever the number of documents.
        upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        running = sums.withColumn("upto", F.sum("tokens").over(upto)).withColumnRenamed("source", "_s")
        joined = state.join(running, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        over = F.col("upto") > F.col("left")
        # The first bucket beyond the budget, and what is left of the budget at its start.
        edge = F.min(F.when(over, F.struct("bucket", (F.col("left") - F.col("upto") + F.col("tokens")).alias("rest"), "tokens")))
        state = joined.groupBy("source", "source_size", "target", "whole").agg(edge.alias("edge"))
        if step < LEVELS:
            # Without a bucket beyond the budget, everything below the prefix is taken ("~" sorts last).
            state = state.select(
                "source", "source_size", "target", "whole",
                F.coalesce("edge.rest", F.lit(0.0)).alias("left"),
                F.coalesce("edge.bucket", F.lit("~")).alias("prefix"),
            )
            if step == 1:
                finished = state.filter("prefix = '~'")
                state = state.filter("prefix <> '~'")
    # The last bucket is one digest: take it if that is nearer to the target.
    nearer = F.coalesce(2 * F.col("edge.rest") > F.col("edge.tokens"), F.lit(False))
    last = state.select(
        "source", "source_size", "target", "whole",
        nearer.alias("with_edge"),
        F.col("edge.bucket").alias("upto"),
    )
    done = finished.select("source", "source_size", "target", "whole", F.lit(True).alias("with_edge"), F.col("prefix").alias("upto"))
    return last.unionByName(done)


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """All rows and columns of `docs` with size, source_size, target, repeats and taken (words)."""
    kept = without(docs, "size", "source_size", "target", "repeats", "taken")
    named = kept.select(F.col(source).alias("source"), digest(id_col).alias("digest"), word_count(text).alias("size"))
    # The table of digests is read once a level; the texts are not.
    sized = cut_lineage(named)
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = thresholds(sized, targets(sizes)).withColumnsRenamed({c: f"_{c}" for c in ("source", "whole", "with_edge", "upto")})
    plan = cut_lineage(plan)
    rows = kept.withColumns({"_digest": digest(id_col), "size": word_count(text)})
    joined = rows.join(plan, F.col(source).eqNullSafe(F.col("_source")))
    under = (F.col("_digest") < F.col("_upto")) | (F.col("_with_edge") & (F.col("_digest") == F.col("_upto")))
    repeats = F.when(F.col("size") > 0, F.least(F.col("_whole") + F.when(under, 1).otherwise(0), F.lit(MOST_REPEATS))).otherwise(0)
    out = joined.withColumn("repeats", repeats.cast("long")).withColumn("taken", F.col("repeats") * F.col("size"))
    return out.select(*kept.columns, "size", "source_size", "target", "repeats", "taken")
