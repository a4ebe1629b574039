"""Sets of word 5-grams that overlap by 4/5 or more: a size-aware heavy-light join.

Sets that are equal become one node first. Small sets list their subsets of the size that two
sets of their sizes must share; equal subsets are links without further check. Large sets look
through inverted lists: each puts its rarest shingles, as many as a partner cannot all miss, in
lists, and sets that meet in a list are compared whole. The rank of the shingle bounds the size of
partners: what is rarer than the first common shingle is missing in one of the two. A cost count decides up to which size
sets are small.

Groups of near copies meet in the same lists again and again, so pairs are not listed at once:
in each list every set is compared with one set drawn at random, links join sets to groups, and
only when few pairs of different groups are left in the lists, or drawing no longer helps, are all
of these compared, in blocks of sets and not as pairs. After
that no link between different groups can be missing, so the groups are exact.

Defined cases: an absent or empty text, or one without words, is an empty set, linked with
nothing; a text of fewer than 5 words is one shingle; equal texts are one group, whatever their
ids; a group's id is the smallest id in it that is present; other columns are not read. Shingles
are compared by 64-bit hashes, equal sets by 128-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.llm.blocks import answers_of, bucket_bits, counted, requests, squeeze, token_blocks, unpack_sorted, unsqueeze
from versemill.llm.components import components, connect, with_partners
from versemill.session import cut_lineage

GRAM = 5
#: Tokens a block: nearly every token gives a shingle of its own.
BLOCK_TOKENS = 1_000_000
#: Sets are never listed by subsets if one set would need more of them.
MOST_SUBSETS = 1200
#: Sets a block when the nodes of a group are compared with others.
VISIT_BLOCK = 512
SCAN, SUBSET, SET = 0, 1, 2
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]


def least_overlap(a, b):
    """Smallest intersection of sets of these sizes with 100 * intersection >= 80 * union."""
    return (4 * (a + b) + 8) // 9


def prefix_length(n):
    """Of so many elements a linked set must have one, whichever they are."""
    return n - (4 * n + 4) // 5 + 1


def reach(n, rank):
    """Largest size of a set whose first common element with a set of `n` elements has this rank
    there: the elements from the rank on must make up the least overlap."""
    return (9 * (n - rank) - 4 * n) // 4


def subset_count(n: int) -> int:
    return sum(comb(n, least_overlap(n, m)) for m in range(-(-4 * n // 5), 5 * n // 4 + 1))


SMALL_LIMIT = next(n for n in range(1, 100) if subset_count(n + 1) > MOST_SUBSETS)


def finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def shingle_sets(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document of each element, element, sizes): the distinct shingles of a block's documents,
    by document and then by value."""
    lengths = np.asarray(row["lengths"], np.int64)
    hashes = finish(unpack_sorted(row["words"]))[unsqueeze(row["codes"])]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    docs, keys = [], []
    if len(hashes) >= GRAM:
        m = len(hashes) - GRAM + 1
        key = np.zeros(m, np.uint64)
        for i in range(GRAM):
            key = (key + hashes[i : i + m]) * MIX[i]
            key ^= key >> np.uint64(31)
        inside = owner[:m] == owner[GRAM - 1 :]
        docs.append(owner[:m][inside])
        keys.append(key[inside])
    starts = np.cumsum(lengths) - lengths
    short = np.flatnonzero((lengths > 0) & (lengths < GRAM))
    if len(short):  # the whole sequence; its length is part of the key
        key = lengths[short].astype(np.uint64) * MIX[0]
        for i in range(GRAM - 1):
            has = lengths[short] > i
            at = np.minimum(starts[short] + i, len(hashes) - 1)
            key = np.where(has, finish(key + hashes[at] * MIX[i + 1]), key)
        docs.append(short)
        keys.append(key)
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(lengths), np.int64)
    doc, key = np.concatenate(docs), finish(np.concatenate(keys))
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    doc, key = doc[new], key[new]
    return doc, key, np.bincount(doc, minlength=len(lengths))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            _, key, sizes = shingle_sets(row)
            ends = np.cumsum(sizes)
            marks = [xxhash.xxh3_128_digest(key[e - n : e].tobytes()) if n else None for n, e in zip(sizes, ends)]
            ids = pa.array(row["ids"], batch.schema.field("ids").type.value_type)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(sizes), row["block"]), pa.int64()),
                    pa.array(np.arange(len(sizes)), pa.int32()),
                    ids,
                    pa.array(sizes, pa.int64()),
                    pa.array(marks, pa.binary()),
                ],
                names=["block", "place", "id", "n", "mark"],
            )


def _keys_of(row: dict) -> list[tuple[int, np.ndarray, np.ndarray]]:
    keys, n = np.unique(shingle_sets(row)[1], return_counts=True)
    return [(0, keys, n)]


def _pack_homes(key, pdf):
    import pandas as pd

    pdf = pdf.sort_values("place")
    return pd.DataFrame(
        {
            "kind": [1, 2],
            "bucket": [0, 0],
            "block": [int(pdf["block"].iloc[0])] * 2,
            "sums": [squeeze(pdf["place"].to_numpy(np.int64)), squeeze(pdf["node"].to_numpy(np.int64))],
            "present": [0, 0],
        }
    )


def _lists(key, block, answers):
    """Rows for the lists of one block's sets: (SCAN: rare shingle, `high` is its reach), (SUBSET:
    subset of a small set for a pair of sizes), (SET: the whole set, if it is in a list)."""
    import pandas as pd

    out = {"kind": [], "key": [], "node": [], "n": [], "low": [], "high": [], "cost": [], "elements": []}

    def put(kind, keys, nodes, n, low, high, cost, elements):
        for name, x in zip(out, (kind, keys, nodes, n, low, high, cost, elements)):
            out[name].append(x)

    sums = {} if block.empty else answers_of(answers)
    if 1 in sums:
        doc, elements, sizes = shingle_sets(block.iloc[0])
        distinct, place = np.unique(elements, return_inverse=True)
        frequency = sums[0][place]
        node_of = np.full(len(sizes), -1)
        node_of[sums[1]] = sums[2]
        ours = node_of[doc] >= 0
        doc, elements, frequency = doc[ours], elements[ours], frequency[ours]
        order = np.lexsort((elements, frequency, doc))
        first = np.searchsorted(doc, np.arange(len(sizes)))  # doc is sorted, and so is doc[order]
        rank = np.arange(len(doc)) - first[doc]
        listed = (rank < prefix_length(sizes[doc])) & (frequency[order] > 1)
        at = order[listed]
        n_listed = len(at)
        none = np.zeros(n_listed, np.int64)
        far = reach(sizes[doc[at]], rank[listed])
        put(np.full(n_listed, SCAN), elements[at].view(np.int64), node_of[doc[at]], sizes[doc[at]], none, far, frequency[at], [None] * n_listed)
        last = np.append(first[1:], len(doc))
        for d in np.unique(doc[at]).tolist():
            whole = elements[first[d] : last[d]]
            put([SET], [0], [node_of[d]], [sizes[d]], [0], [0], [0], [whole.tobytes()])
            n = int(sizes[d])
            if n > SMALL_LIMIT:
                continue
            shared = np.sort(whole[frequency[first[d] : last[d]] > 1])
            for m in range(-(-4 * n // 5), 5 * n // 4 + 1):
                pair = min(n, m).to_bytes(2, "little") + max(n, m).to_bytes(2, "little")
                for subset in combinations(shared, least_overlap(n, m)):
                    mark = xxhash.xxh3_64_intdigest(pair + np.array(subset, np.uint64).tobytes())
                    put([SUBSET], [int(np.uint64(mark).astype(np.int64))], [node_of[d]], [n], [min(n, m)], [max(n, m)], [1], [None])
    columns = {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for k, v in out.items() if k != "elements"}
    return pd.DataFrame(columns | {"elements": [x for xs in out["elements"] for x in xs]})


def small_size(costs: list) -> int:
    """The size up to which listing subsets is cheaper than scanning lists, in rows touched."""
    subsets, scans = [0] * (SMALL_LIMIT + 1), [0] * (SMALL_LIMIT + 1)
    for row in costs:
        (subsets if row["kind"] == SUBSET else scans)[row["n"]] = row["cost"]
    return min(range(SMALL_LIMIT + 1), key=lambda x: (sum(subsets[: x + 1]) + sum(scans[x + 1 :]), x))


def subset_links(rows: DataFrame, small: int) -> DataFrame:
    """Links of sets that list the same subset for the same pair of sizes, as stars.

    Such sets share the subset, so any two with these two sizes are linked: everything of one
    size hangs on the smallest node of the other (of the same, if the sizes are equal).
    """
    listed = rows.filter((F.col("kind") == SUBSET) & (F.col("high") <= small)).select("key", "node", "n", "low", "high")
    hubs = listed.groupBy("key").agg(
        F.min(F.when(F.col("n") == F.col("high"), F.col("node"))).alias("upper"),
        F.min(F.when(F.col("n") < F.col("high"), F.col("node"))).alias("lower"),
        F.count("*").alias("held"),
    )
    hubs = hubs.filter("held > 1").select(F.col("key").alias("_k"), "upper", "lower")
    other = F.when((F.col("n") == F.col("high")) & (F.col("low") < F.col("high")), F.col("lower")).otherwise(F.col("upper"))
    joined = listed.join(hubs, F.col("key") == F.col("_k"))
    return joined.select(F.col("node").alias("a"), other.alias("b")).filter("b IS NOT NULL AND a <> b")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * both >= 80 * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
        )


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) → (a, b, linked), by the whole sets (written)."""
    left = sets.select(F.col("node").alias("_a"), F.col("elements").alias("left"))
    right = sets.select(F.col("node").alias("_b"), F.col("elements").alias("right"))
    joined = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
    return cut_lineage(joined.select("a", "b", "left", "right").mapInArrow(_compare, "a long, b long, linked boolean"))


def _visit(key, members, visitors):
    """Links of one block of visitors with one of members: those that join parts that are not yet
    connected here. Nodes of one component are connected already."""
    import pandas as pd

    out, parent = [], {}

    def root(x):
        while (up := parent.get(x, x)) != x:
            x = parent[x] = parent.get(up, up)
        return x

    if len(members) and len(visitors):
        held = [np.frombuffer(x, np.uint64) for x in members["elements"]]
        sizes = np.array([len(h) for h in held])
        owner, every = np.repeat(np.arange(len(held)), sizes), np.concatenate(held)
        nodes, components_ = members["node"].to_numpy(), members["component"].to_numpy()
        for node, component, x in zip(visitors["node"], visitors["component"], visitors["elements"]):
            own = np.frombuffer(x, np.uint64)
            place = np.searchsorted(own, every)
            common = own[np.minimum(place, len(own) - 1)] == every
            both = np.bincount(owner[common], minlength=len(held))
            linked = (100 * both >= 80 * (sizes + len(own) - both)) & (components_ != component)
            for other, at in zip(*np.unique(components_[linked], return_index=True)):
                if (one := root(int(other))) != (two := root(int(component))):
                    parent[max(one, two)] = min(one, two)
                    y = int(nodes[linked][at])
                    out.append((max(node, y), min(node, y)))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def visited(members: DataFrame, visitors: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of (group, node, component) members and visitors of other components by their whole
    sets, as many as connect what they link (written).

    Both sides of a group are dealt to blocks of about VISIT_BLOCK nodes, and each block of
    members meets each block of visitors, as rows of sets and not of pairs.
    """
    counts = members.groupBy("group").agg(F.count("*").alias("m")).join(visitors.groupBy("group").agg(F.count("*").alias("v")), "group")
    blocks = lambda n: F.ceil(F.col(n) / VISIT_BLOCK).cast("int")
    counts = cut_lineage(counts.select(F.col("group").alias("_g"), blocks("m").alias("m"), blocks("v").alias("v")))
    elements = sets.select(F.col("node").alias("_node"), "elements")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.join(counts, F.col("group") == F.col("_g")).join(elements, F.col("node") == F.col("_node"))
        at = F.pmod(F.xxhash64("node"), F.col(own)).cast("int").alias(f"at_{own}")
        plain = [F.col(c).alias(c) for c in ("group", "node", "component", "elements")]  # columns of this side alone
        return rows.select(*plain, at, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"at_{other}"))

    keys = ["group", "at_m", "at_v"]
    both = dealt(members, "m", "v").groupBy(*keys).cogroup(dealt(visitors, "v", "m").groupBy(*keys))
    return cut_lineage(both.applyInPandas(_visit, "a long, b long"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component, component_id) of every row of `docs`; `component` is absent for
    empty sets. `component_id` is the smallest id of the group."""
    named = docs.select(F.col(id_col).alias("id"), F.lit(False).alias("flag"), F.col(text).cast("string").alias("text"))
    kind = dict(named.dtypes)["id"]
    blocks = token_blocks(named, False, BLOCK_TOKENS)
    marked = cut_lineage(blocks.mapInArrow(_signatures, f"block long, place int, id {kind}, n long, mark binary"))
    classes = marked.filter("n > 0").groupBy("mark").agg(
        F.min("id").alias("first"), F.min(F.struct("block", "place")).alias("home"), F.first("n").alias("n")
    )
    # One node for each set; its home is the document whose block lists it.
    nodes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))
    homes = nodes.select("home.block", "home.place", "node").groupBy("block").applyInPandas(
        _pack_homes, "kind int, bucket int, block long, sums binary, present long"
    )
    elements = marked.agg(F.sum("n")).head()[0] or 0
    answers = counted(requests(blocks, _keys_of, bucket_bits(elements))).unionByName(homes)
    listed = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        _lists, "kind int, key long, node long, n long, low long, high long, cost long, elements binary"
    )
    listed = cut_lineage(listed)
    costs = listed.filter(F.col("kind") != SET).filter(F.col("n") <= SMALL_LIMIT).groupBy("kind", "n").agg(F.sum("cost").alias("cost"))
    small = small_size(costs.collect())  # a row for each small size and kind
    links = cut_lineage(subset_links(listed, small).select("a", "b"))
    # A large set can be linked with small ones down to 4/5 of its size.
    scan = listed.filter((F.col("kind") == SCAN) & (5 * F.col("n") >= 4 * (small + 1))).select("key", "node", "n", F.col("high").alias("reach"))
    sets = listed.filter(F.col("kind") == SET).select("node", "elements")
    links = connect(cut_lineage(with_partners(scan)), links, lambda pairs: compared(pairs, sets), lambda m, v: visited(m, v, sets))
    groups = components(links).select(F.col("node").alias("_node"), "component")
    joined = nodes.join(groups, F.col("node") == F.col("_node"), "left").select(
        "mark", "first", F.coalesce("component", "node").alias("component")
    )
    joined = cut_lineage(joined)
    names = joined.groupBy(F.col("component").alias("_c")).agg(F.min("first").alias("component_id"))
    by_mark = joined.join(names, F.col("component") == F.col("_c")).select(F.col("mark").alias("_mark"), "component", "component_id")
    out = marked.join(by_mark, F.col("mark") == F.col("_mark"), "left")
    return out.select("id", F.col("n").alias("n_shingles"), "component", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
