"""Connected groups: of a graph given as links, and of nodes that meet in lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between numbers → (node, component): the smallest number a node can reach.

    Only nodes with a link to another one are returned. Each round hangs neighbours on the
    smallest of them, so chains shorten by half or more; hubs cost one aggregate. All rounds are
    joins and aggregates on written tables.
    """
    edges = cut_lineage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")).withColumn("m", F.least("x", "m"))
        up = both.filter("v > u").join(least, F.col("u") == F.col("x"))
        large = up.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        parent = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        down = large.join(parent, F.col("u") == F.col("x")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(down.unionByName(parent.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct())
        roots = edges.select(F.col("v").alias("r")).distinct()
        twice = edges.groupBy("u").count().filter("count > 1")
        if edges.join(roots, F.col("u") == F.col("r"), "left_semi").isEmpty() and twice.isEmpty():
            nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.unionByName(roots.select(F.col("r").alias("node"), F.col("r").alias("component")))


def fits(n: str, reach: str, m: str, other_reach: str) -> Column:
    return (F.col(m) <= F.col(reach)) & (F.col(n) <= F.col(other_reach))


def with_partners(rows: DataFrame) -> DataFrame:
    """Rows of lists that can have a partner in their list.

    The smaller node of a pair that fits also fits itself (its size is within its own reach), so a
    list needs such a node, and a node beyond its own reach needs a smaller one within it.
    """
    itself = F.col("n") <= F.col("reach")
    lists = rows.groupBy(F.col("key").alias("_k")).agg(
        F.count("*").alias("held"), F.min(F.when(itself, F.col("n"))).alias("least")
    )
    lists = lists.filter("held > 1 AND least IS NOT NULL")
    return rows.join(lists, (F.col("key") == F.col("_k")) & (F.col("least") <= F.col("reach"))).select("key", "node", "n", "reach")


def grouped(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows with `component` under the links so far."""
    named = components(links).select(F.col("node").alias("_node"), "component")
    return rows.join(named, F.col("node") == F.col("_node"), "left").select(
        "key", "node", "n", "reach", F.coalesce("component", "node").alias("component")
    )


def left_over(rows: DataFrame) -> DataFrame:
    """(_k, total, main, mains) of the lists in which different groups meet; `main` is the group
    with most nodes there."""
    by_group = rows.groupBy("key", "component").agg(F.count("*").alias("held"))
    lists = by_group.groupBy(F.col("key").alias("_k")).agg(
        F.sum("held").alias("total"), F.max(F.struct("held", "component")).alias("main"), F.count("*").alias("groups")
    )
    return lists.filter("groups > 1").select("_k", "total", F.col("main.component").alias("main"), F.col("main.held").alias("mains"))


def connect(
    rows: DataFrame,
    links: DataFrame,
    compare: Callable[[DataFrame], DataFrame],
    visit: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    meet: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Links (a, b) that, with `links`, connect all nodes that are linked and meet in a list.

    `rows` is a written table with (key, node, n, reach): a node of size n is in the list `key`, and
    there it can be linked with nodes of sizes up to `reach`. `compare` adds `linked` to pairs (a, b), as a written
    table. Nodes of one group need not be compared, so each node is first compared with one drawn
    at random, list by list; when few pairs of different groups still meet, or drawing no longer
    helps, all of these pairs are compared. With `visit`, that is done in blocks instead of pairs:
    the nodes outside the main group of a list are visitors of that group, and are compared with its
    nodes and with each other, once however many lists they share. It takes (group, node, component)
    of members and of visitors and returns links that connect what they link. With `meet`, it is done
    where the lists are: it takes their rows with `component` and `main`, and returns the links (a, b)
    of nodes outside the main group of a list with all nodes of other groups there.
    """
    done, turn, before = None, 0, None
    while True:
        # The groups so far, and the pairs of different groups that still meet.
        named = cut_lineage(grouped(rows, links))
        open_lists = cut_lineage(left_over(named))
        size = open_lists.agg(
            F.sum("total").alias("rows"), F.sum((F.col("total") - F.col("mains")) * F.col("total")).alias("pairs")
        ).head()
        if not size["rows"]:
            return links
        last = size["pairs"] <= 4 * size["rows"] or (before is not None and size["pairs"] > 0.7 * before)
        before = size["pairs"]
        here = named.join(open_lists, F.col("key") == F.col("_k")).drop("_k")
        rows = here.select("key", "node", "n", "reach")  # a list of one group stays one
        other = {"node": "y", "n": "yn", "reach": "yr", "component": "yc"}
        if last and meet is not None:
            return links.unionByName(meet(here.select(*rows.columns, "component", "main")))
        if last:
            # Every node outside the main group of a list against all nodes of other groups there.
            others = here.filter("component <> main")
            if visit is not None:
                side = lambda nodes: nodes.select(F.col("main").alias("group"), "node", "component").distinct()
                return links.unionByName(visit(side(here), side(others)))
            all_here = here.select(F.col("key").alias("_k"), *[F.col(c).alias(x) for c, x in other.items()])
            meets = (F.col("key") == F.col("_k")) & (F.col("component") != F.col("yc")) & fits("n", "reach", "yn", "yr")
            once = (F.col("yc") == F.col("main")) | (F.col("node") < F.col("y"))
            met = others.join(all_here, meets & once)
            pairs = met.select(F.greatest("node", "y").alias("a"), F.least("node", "y").alias("b"))
        else:
            turn += 1
            drawn = F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), *other)).alias("one")
            one = here.filter("n <= reach").groupBy(F.col("key").alias("_k")).agg(drawn)
            one = one.select("_k", "one.h", *[F.col(f"one.{c}").alias(x) for c, x in other.items()])
            meets = (F.col("key") == F.col("_k")) & (F.col("component") != F.col("yc")) & fits("n", "reach", "yn", "yr")
            best = here.join(one, meets).groupBy("node").agg(F.min(F.struct("h", "y")).alias("best"))
            pairs = best.select(F.greatest("node", "best.y").alias("a"), F.least("node", "best.y").alias("b"))
        pairs = pairs.distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        judged = compare(pairs)
        links = links.unionByName(judged.filter("linked").select("a", "b"))
        if last:
            return links
        tested = judged.select("a", "b")
        done = tested if done is None else done.unionByName(tested)
