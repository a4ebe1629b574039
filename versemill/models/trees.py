"""Decision trees, forests and boosted trees on features that are binned once.

All trees of all fits grow together, level by level. At each level every block of rows adds up
two statistics by (fit, tree, node, feature, bin); Spark groups these sums by node, and a node's
task picks the split, so only the chosen splits come to the driver. No row is moved. A row's node
follows from the splits so far. Rows and columns that a tree draws follow from seeds and the row's
key, so a repeated task draws the same.

Statistics are whole numbers (weights and labels, or gradients and hessians in steps of 2 ** -24),
so sums do not depend on the order of rows, and the trees not on the partitioning.

Boosting is a long chain of small steps. A table of up to `IN_TASK` cells (rows times features) is
therefore grown by one task for each fit (for some trees of a forest), by the same functions and
with the same trees.

Defined cases: features without a value count as 0; rows without a label are not fitted; equal gains
go to the first feature and then to the lowest cut; a node without a split that gains is a leaf.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.session import cut_lineage

#: Bins of a feature, as cut by its quantiles.
BINS = 32
#: Cells of a table that one task may hold, and rows of a block.
IN_TASK, BLOCK_ROWS = 50_000_000, 50_000
#: Counts that a task holds in one pass over the quantiles.
EDGE_CELLS = 1 << 18
#: Nodes of the trees that are sent to the tasks at once (17 bytes each).
WAVE = 2_000_000
#: Gradients are whole multiples of 1 / SCALE.
SCALE = 1 << 24
#: Boosting rounds after which margins are written.
WRITE_EVERY = 10
#: Trees of a forest that one task grows, where it holds the table.
TREES_A_TASK = 25
#: Cells and nodes whose sums one task makes at once.
CELLS_AT_ONCE, NODES_AT_ONCE = 1 << 20, 1024
BLOCK = "bins binary, n int, label binary, key binary, fold binary, margin binary"
SPLIT = "fit int, tree int, node long, feature int, cut int, gain double, a0 double, a1 double, b0 double, b1 double, all0 double, all1 double"
MODEL = "fit int, tree int, node long, feature int, cut int, value double, gain double"


@dataclass(frozen=True)
class TreeFit:
    """One fit: its kind of gain (`gini`, `entropy` or `boost`), sizes and draws.

    `left_out` is a fold whose rows are not fitted. `columns` is the share of columns that a tree
    (boosting) or a node (`per_node`) draws, `rows` the share of rows of a tree, `bootstrap` draws
    rows with repetition. `only` are the columns that are drawn from (all where none are named).
    """

    kind: str = "boost"
    trees: int = 1
    depth: int = 10
    min_leaf: int = 1
    min_split: int = 2
    rows: float = 1.0
    columns: float = 1.0
    per_node: bool = False
    bootstrap: bool = False
    rate: float = 0.1
    shrink: float = 1.0
    seed: int = 42
    left_out: int = -1
    only: tuple[int, ...] | None = None


def decision_tree(impurity: str = "entropy", depth: int = 10, **more) -> TreeFit:
    return TreeFit(kind=impurity, depth=depth, **more)


def random_forest(n_features: int, trees: int = 200, depth: int = 15, **more) -> TreeFit:
    share = max(1, int(n_features**0.5)) / n_features
    return TreeFit(kind="gini", trees=trees, depth=depth, columns=share, per_node=True, bootstrap=True, **more)


def gradient_boosting(rounds: int = 200, depth: int = 8, rows: float = 0.8, **more) -> TreeFit:
    return TreeFit(kind="boost", trees=rounds, depth=depth, rows=rows, columns=0.8, **more)


@dataclass
class Grown:
    """A tree: its splits (node → feature, cut) and the value of every node. Children of node k
    are 2k (up to the cut) and 2k + 1."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)
    gains: dict[int, float] = field(default_factory=dict)


def plain(trees: dict[tuple[int, int], Grown]) -> dict:
    """Trees without classes, as broadcasts are not unpacked with the functions of this package."""
    return {k: (tree.splits, tree.values) for k, tree in trees.items()}


def again(trees: dict) -> dict[tuple[int, int], Grown]:
    return {k: Grown(splits, values) for k, (splits, values) in trees.items()}


def mixed(key: np.ndarray, *numbers: int) -> np.ndarray:
    """A 64-bit hash of keys and numbers, as uniform numbers below 1."""
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64)
        for n in numbers:
            x = (x ^ np.uint64(n + 1)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(29)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


def row_weights(fit: TreeFit, tree: int, key: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """How often each row counts in a tree."""
    u = mixed(key, fit.seed, tree)
    if fit.bootstrap:  # Poisson, one row on average
        weight, term, below = np.zeros(len(u)), np.exp(-1.0), np.exp(-1.0)
        for n in range(1, 12):
            weight += u >= below
            term /= n
            below += term
    else:
        weight = (u < fit.rows).astype(np.float64)
    return np.where(fold == fit.left_out, 0.0, weight)


def drawn_columns(fit: TreeFit, tree: int, node: int, n: int) -> np.ndarray:
    among = np.arange(n) if fit.only is None else np.array(fit.only)
    if fit.columns < 1:
        rng = np.random.default_rng([fit.seed, tree, node if fit.per_node else 0])
        among = among[rng.choice(len(among), max(1, round(fit.columns * len(among))), replace=False)]
    out = np.zeros(n, bool)
    out[among] = True
    return out


def node_of(tree: Grown, bins: np.ndarray) -> np.ndarray:
    """The node that each row has come to."""
    node = np.ones(len(bins), np.int64)
    size = max(tree.splits, default=0) + 1
    feature, cut = np.full(size, -1), np.zeros(size, np.int64)
    for k, (f, c) in tree.splits.items():
        feature[k], cut[k] = f, c
    rows = np.arange(len(bins))
    while len(rows):
        at = node[rows]
        inner = at < size
        rows, at = rows[inner], at[inner]
        inner = feature[at] >= 0
        rows, at = rows[inner], at[inner]
        node[rows] = 2 * at + (bins[rows, feature[at]] > cut[at])
    return node


def value_of(tree: Grown, bins: np.ndarray) -> np.ndarray:
    values = np.zeros(max(tree.values, default=0) + 2)
    for k, v in tree.values.items():
        values[k] = v
    return values[node_of(tree, bins)]


def statistics(fit: TreeFit, label: np.ndarray, margin: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if fit.kind != "boost":
        return weight, weight * label
    p = 1 / (1 + np.exp(-margin))
    return np.rint(weight * p * (1 - p) * SCALE), np.rint(weight * (p - label) * SCALE)


def histograms(bins: np.ndarray, place: np.ndarray, n: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """[node, feature, bin, statistic] of the rows with a place from 0 on."""
    width = bins.shape[1]
    rows = np.nonzero(place >= 0)[0]
    cell = ((place[rows, None] * width + np.arange(width)) * BINS + bins[rows]).ravel()
    size = n * width * BINS
    sums = [np.bincount(cell, np.repeat(s[rows], width), size) for s in (first, second)]
    return np.stack(sums, -1).reshape(n, width, BINS, 2)


def worth(fit: TreeFit, s0: np.ndarray, s1: np.ndarray) -> np.ndarray:
    """What a node is worth; a split gains the worth of both parts less that of the whole."""
    if fit.kind == "boost":
        return s1 * s1 / SCALE / (s0 + fit.shrink * SCALE)
    p = np.divide(s1, s0, out=np.zeros_like(s0), where=s0 > 0)
    if fit.kind == "gini":
        return -s0 * 2 * p * (1 - p)
    safe = lambda q: q * np.log2(np.where(q > 0, q, 1.0))
    return s0 * (safe(p) + safe(1 - p))


def best_split(fit: TreeFit, drawn: np.ndarray, sums: np.ndarray) -> tuple:
    """(feature or -1, cut, gain, sums of the left part, of the right, of the node) by the sums of
    the drawn features."""
    whole = sums[0].sum(0)
    left = np.cumsum(sums, 1)[:, :-1]
    right = whole - left
    least = SCALE if fit.kind == "boost" else fit.min_leaf
    allowed = (left[..., 0] >= least) & (right[..., 0] >= least)
    gain = worth(fit, left[..., 0], left[..., 1]) + worth(fit, right[..., 0], right[..., 1]) - worth(fit, *whole.reshape(2, 1))
    # Differences of the order of rounding are ties, and ties go to the first.
    gain = np.where(allowed, np.round(gain, 9), -np.inf)
    at = int(np.argmax(gain))
    column, cut = divmod(at, BINS - 1)
    enough = fit.kind == "boost" or whole[0] >= fit.min_split
    if not enough or not gain[column, cut] > 0:
        return -1, 0, 0.0, whole, whole, whole
    return int(drawn[column]), cut, float(gain[column, cut]), left[column, cut], right[column, cut], whole


def leaf_value(fit: TreeFit, s: np.ndarray) -> float:
    if fit.kind == "boost":
        return float(-fit.rate * s[1] / (s[0] + fit.shrink * SCALE))
    return float(s[1] / s[0]) if s[0] else 0.0


Open = dict[tuple[int, int], tuple[Grown, list[int]]]


def grow(fits: list[TreeFit], trees: dict[int, list[int]], splits: Callable[[Open], Iterator[tuple]]) -> dict[tuple[int, int], Grown]:
    """The trees of each fit, level by level. `splits` finds the split of every open node."""
    grown = {(i, t): Grown() for i, numbers in trees.items() for t in numbers}
    open_: Open = {k: (tree, [1]) for k, tree in grown.items()}
    while open_:
        onward: dict[tuple[int, int], list[int]] = {}
        for i, t, node, feature, cut, gain, left, right, whole in splits(open_):
            fit, tree = fits[i], grown[i, t]
            tree.values.setdefault(node, leaf_value(fit, whole))
            if feature < 0 or node.bit_length() > fit.depth:
                continue
            tree.splits[node], tree.gains[node] = (feature, cut), gain
            tree.values[2 * node], tree.values[2 * node + 1] = leaf_value(fit, left), leaf_value(fit, right)
            if node.bit_length() < fit.depth:
                onward.setdefault((i, t), []).extend((2 * node, 2 * node + 1))
        open_ = {k: (grown[k], sorted(nodes)) for k, nodes in onward.items()}
    return grown


def block_sums(fits: list[TreeFit], open_: Open, bins, label, key, fold, margins) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(fit, tree, node, sums of all features) of one block of rows."""
    for (i, t), (tree, nodes) in open_.items():
        weight = row_weights(fits[i], t, key, fold)
        first, second = statistics(fits[i], label, margins[:, i], weight)
        numbers = np.array(nodes)
        at = node_of(tree, bins)
        place = np.minimum(np.searchsorted(numbers, at), len(numbers) - 1)
        place = np.where((numbers[place] == at) & (weight > 0), place, -1)
        for node, sums in zip(nodes, histograms(bins, place, len(nodes), first, second)):
            yield i, t, node, sums


def unpacked(row: dict, fits: int):
    n = row["n"]
    bins = np.frombuffer(row["bins"], np.uint8).reshape(n, -1)
    label, fold = np.frombuffer(row["label"], np.int8).astype(np.float64), np.frombuffer(row["fold"], np.int32)
    margins = np.frombuffer(row["margin"], np.float64).reshape(n, fits) if row.get("margin") else np.zeros((n, fits))
    return bins, label, np.frombuffer(row["key"], np.int64), fold, margins


def model_rows(grown: dict[tuple[int, int], Grown]) -> list[tuple]:
    return [
        (i, t, node, *tree.splits.get(node, (-1, -1)), value, tree.gains.get(node, 0.0))
        for (i, t), tree in sorted(grown.items())
        for node, value in sorted(tree.values.items())
    ]


def parts_of(fits: list[TreeFit]) -> list[list[tuple[int, range]]]:
    """The (fit, trees) that each task grows: the rounds of boosting hang together, other trees come
    by TREES_A_TASK, those of small fits with each other."""
    parts = [[(i, range(fit.trees))] for i, fit in enumerate(fits) if fit.kind == "boost"]
    room = 0
    for i, fit in enumerate(fits):
        done = fit.trees if fit.kind == "boost" else 0
        while done < fit.trees:
            if not room:
                parts.append([])
                room = TREES_A_TASK
            size = min(room, fit.trees - done)
            parts[-1].append((i, range(done, done + size)))
            done, room = done + size, room - size
    return parts


def rounds_of(fits: list[TreeFit], i: int) -> Iterator[list[int]]:
    """The trees of a fit that can grow at once: all, or one round after the other."""
    if fits[i].kind == "boost":
        yield from ([t] for t in range(fits[i].trees))
    else:
        yield list(range(fits[i].trees))


def cells_here(bins: np.ndarray, rows: np.ndarray, place: np.ndarray, columns: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """[node, drawn column, bin, statistic] of `rows`, which lie in the nodes `place` with the drawn
    `columns` [node, k]; some rows at once."""
    n, k = columns.shape
    out = np.zeros((2, n * k * BINS))
    step = max(1, CELLS_AT_ONCE // k)
    for a in range(0, len(rows), step):
        part, at = rows[a : a + step], place[a : a + step]
        cell = ((at[:, None] * k + np.arange(k)) * BINS + bins[part[:, None], columns[at]]).ravel()
        for j, values in enumerate((first, second)):
            out[j] += np.bincount(cell, np.repeat(values[part], k), n * k * BINS)
    return np.moveaxis(out.reshape(2, n, k, BINS), 0, -1)


def tree_here(fit: TreeFit, t: int, bins: np.ndarray, label, key, fold, margin: np.ndarray) -> Grown:
    """A tree on rows in memory, the same as `grow` makes: sums of the drawn columns only, and where
    a tree draws once for all nodes, of the smaller child (the other has what is left of the parent)."""
    tree, width = Grown(), bins.shape[1]
    weight = row_weights(fit, t, key, fold)
    first, second = statistics(fit, label, margin, weight)
    rows = np.flatnonzero(weight > 0)
    nodes, place = [1], np.zeros(len(rows), np.int64)
    above: list[np.ndarray | None] = []  # sums of the parents, by place of the first child
    while nodes:
        drawn = np.stack([np.flatnonzero(drawn_columns(fit, t, node, width)) for node in nodes])
        sums: list[np.ndarray] = [None] * len(nodes)
        counted = list(range(len(nodes)))
        if above:
            size = np.bincount(place, minlength=len(nodes))
            counted = [i if size[i] <= size[i + 1] else i + 1 for i in range(0, len(nodes), 2)]
        number = np.full(len(nodes), -1)
        number[counted] = np.arange(len(counted))
        inside = number[place] >= 0
        for start in range(0, len(counted), NODES_AT_ONCE):
            some = counted[start : start + NODES_AT_ONCE]
            now = inside & (number[place] >= start) & (number[place] < start + len(some))
            held = cells_here(bins, rows[now], number[place[now]] - start, drawn[some], first, second)
            for i, s in zip(some, held):
                sums[i] = s
        for i in range(0, len(nodes), 2) if above else ():
            known = i if sums[i] is not None else i + 1
            sums[i ^ 1 if known == i else i] = above[i // 2] - sums[known]
        onward, kept, place_of = [], [], np.full((len(nodes), 2), -1)
        feature, cut = np.full(len(nodes), -1), np.zeros(len(nodes), np.int64)
        for i, node in enumerate(nodes):
            column, c, gain, left, right, whole = best_split(fit, drawn[i], sums[i])
            tree.values.setdefault(node, leaf_value(fit, whole))
            if column < 0 or node.bit_length() > fit.depth:
                continue
            tree.splits[node], tree.gains[node] = (column, c), gain
            tree.values[2 * node], tree.values[2 * node + 1] = leaf_value(fit, left), leaf_value(fit, right)
            if node.bit_length() < fit.depth:
                feature[i], cut[i], place_of[i] = column, c, (len(onward), len(onward) + 1)
                onward += [2 * node, 2 * node + 1]
                kept.append(sums[i])
        going = feature[place] >= 0
        rows, place = rows[going], place[going]
        place = place_of[place, (bins[rows, feature[place]] > cut[place]).astype(np.int64)]
        nodes, above = onward, [] if fit.per_node and fit.columns < 1 else kept
    return tree


def grown_here(fits: list[TreeFit], i: int, numbers: range, bins, label, key, fold) -> dict[tuple[int, int], Grown]:
    """Trees of one fit, on rows in memory, one after the other."""
    margin = np.zeros(len(bins))
    out = {}
    for t in numbers:
        out[i, t] = tree_here(fits[i], t, bins, label, key, fold, margin)
        if fits[i].kind == "boost":
            margin += value_of(out[i, t], bins)
    return out


def grown_by_levels(blocks: DataFrame, fits: list[TreeFit]) -> dict[tuple[int, int], Grown]:
    """All trees of all fits, one job a level."""
    context = blocks.sparkSession.sparkContext
    out: dict[tuple[int, int], Grown] = {}
    fresh: list[dict] = []  # rounds whose values are not yet in the written margins
    table = blocks

    def margins_of(row: dict, newer: list[dict]):
        bins, label, key, fold, margins = unpacked(row, len(fits))
        margins = margins.copy()
        for new in newer:
            for (i, _), tree in new.items():
                if fits[i].kind == "boost":
                    margins[:, i] += value_of(tree, bins)
        return bins, label, key, fold, margins

    def splits(open_: Open) -> Iterator[tuple]:
        sent = context.broadcast((plain({k: tree for k, (tree, _) in open_.items()}), {k: nodes for k, (_, nodes) in open_.items()}, [plain(f) for f in fresh]))

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, numbers, newer = sent.value
            nodes = {k: (tree, numbers[k]) for k, tree in again(trees).items()}
            newer = [again(f) for f in newer]
            for batch in batches:
                for row in batch.to_pylist():
                    for i, t, node, s in block_sums(fits, nodes, *margins_of(row, newer)):
                        yield pa.RecordBatch.from_pydict(
                            {
                                "fit": pa.array([i], pa.int32()), "tree": pa.array([t], pa.int32()), "node": pa.array([node], pa.int64()),
                                "sums": pa.array([s.tobytes()], pa.binary()),
                            }
                        )

        def best(key, pdf):
            import pandas as pd

            i, t, node = (int(k) for k in key)
            total = sum(np.frombuffer(s, np.float64) for s in pdf["sums"]).reshape(-1, BINS, 2)
            drawn = np.flatnonzero(drawn_columns(fits[i], t, node, len(total)))
            feature, cut, gain, *parts = best_split(fits[i], drawn, total[drawn])
            values = [i, t, node, feature, cut, gain, *(float(x) for p in parts for x in p)]
            return pd.DataFrame([values], columns=[c.split()[0] for c in SPLIT.split(", ")])

        found = table.mapInArrow(sums, "fit int, tree int, node long, sums binary").groupBy("fit", "tree", "node").applyInPandas(best, SPLIT)
        for r in found.collect():
            pairs = (np.array([r[a], r[b]]) for a, b in (("a0", "a1"), ("b0", "b1"), ("all0", "all1")))
            yield r["fit"], r["tree"], r["node"], r["feature"], r["cut"], r["gain"], *pairs
        sent.unpersist()

    turns = [rounds_of(fits, i) for i in range(len(fits))]
    while numbers := {i: n for i, turn in enumerate(turns) if (n := next(turn, None))}:
        new = grow(fits, numbers, splits)
        out |= new
        fresh.append(new)
        if len(fresh) == WRITE_EVERY:
            newer = list(fresh)

            def with_margins(batches: Iterator[pa.RecordBatch], newer=newer) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    margin = [margins_of(row, newer)[-1].tobytes() for row in batch.to_pylist()]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(margin, pa.binary())], names=batch.schema.names)

            table = cut_lineage(table.mapInArrow(with_margins, BLOCK))
            fresh.clear()
    return out


def ordered(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the given numbers, one to one (both zeros are one)."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def unordered(keys: np.ndarray) -> np.ndarray:
    return np.where(keys >> np.uint64(63), keys ^ np.uint64(1 << 63), ~keys).view(np.float64)


def _cells(column: str, width: int, known: list[np.ndarray], done: int, bits: int):
    """Rows → (cell, n, lo, hi): how many values go on from a known beginning of `done` bits with
    each of the next `bits` bits, and the least and greatest of them. The beginnings of all features
    are numbered through."""
    first = np.cumsum([0, *map(len, known)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = int(first[-1]) << bits
        n, low, high = np.zeros(size, np.int64), np.full(size, 2**64 - 1, np.uint64), np.zeros(size, np.uint64)
        for batch in batches:
            keys = ordered(matrix_of(batch.column(column), width))
            for d in range(width):
                if not len(known[d]):
                    continue
                key, cell = keys[:, d], np.full(len(keys), first[d] << bits)
                if done:
                    begin = key >> np.uint64(64 - done)
                    at = np.minimum(np.searchsorted(known[d], begin), len(known[d]) - 1)
                    inside = known[d][at] == begin
                    key, cell = key[inside], (first[d] + at[inside]) << bits
                cell = cell + ((key >> np.uint64(64 - done - bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)
                np.add.at(n, cell, 1)
                np.minimum.at(low, cell, key)
                np.maximum.at(high, cell, key)
        at = np.flatnonzero(n)
        signed = ((part[at] ^ np.uint64(1 << 63)).view(np.int64) for part in (low, high))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (at, n[at], *signed)], names=["cell", "n", "lo", "hi"])

    return run


def bin_edges(df: DataFrame, vec_col: str) -> np.ndarray:
    """[feature, edge]: the exact quantiles of each feature; equal ones stand for one edge.

    The bits of the wanted numbers are found from the highest down. A pass counts the next bits of
    the values that begin as a wanted number does, in EDGE_CELLS cells at most (or two a wanted
    number), until all values of a cell are equal. So neither values nor different values are moved.
    """
    row = df.agg(F.max(F.size(vec_col)), F.count("*")).head()
    width, n = row[0] or 0, row[1]
    wanted = sorted({max(0, -(-n * i // BINS) - 1) for i in range(1, BINS)})
    edges: list[set[int]] = [set() for _ in range(width)]
    known = [np.zeros(1, np.uint64) for _ in range(width)]
    # Of each beginning, the wanted ranks among the values that begin so.
    ranks = [[wanted] for _ in range(width)]
    done = 0
    while open_ := sum(map(len, known)):
        bits = min(64 - done, max(1, (EDGE_CELLS // open_).bit_length() - 1))
        counts = df.mapInArrow(_cells(vec_col, width, known, done, bits), "cell long, n long, lo long, hi long").groupBy("cell")
        found = counts.agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toPandas().sort_values("cell")
        cells, sizes, low, high = (found[c].to_numpy(np.int64) for c in ("cell", "n", "lo", "hi"))
        place = 0
        for d in range(width):
            going: dict[int, list[int]] = {}
            for start, held in zip(known[d].tolist(), ranks[d]):
                a, b = np.searchsorted(cells, [place << bits, (place + 1) << bits])
                upto, place = np.cumsum(sizes[a:b]), place + 1
                for rank in held:
                    i = int(np.searchsorted(upto, rank, side="right"))
                    at = a + i
                    if low[at] == high[at]:
                        edges[d].add(int(low[at]) + (1 << 63))
                    else:
                        key = (start << bits) | (int(cells[at]) & ((1 << bits) - 1))
                        going.setdefault(key, []).append(rank - int(upto[i] - sizes[at]))
            known[d], ranks[d] = np.array(list(going), np.uint64), list(going.values())
        done += bits
    out = np.full((width, BINS - 1), np.inf)
    for d, keys in enumerate(edges):
        out[d, : len(keys)] = unordered(np.array(sorted(keys), np.uint64))
    return out


def binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, values[:, d], side="left") for d, e in enumerate(edges)], 1).astype(np.uint8)


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.nan_to_num(flat.reshape(-1, width))


def fit_trees(df: DataFrame, fits: list[TreeFit], vec_col: str, label: str, key: str, fold: str | None = None, in_task: int = IN_TASK) -> Model:
    """All fits on the rows of `df` (labels 0 and 1); `key` names the rows, `fold` numbers from 0."""
    vector, number = F.col(vec_col).cast("array<double>"), F.col(label).cast("int")
    rows = df.select(vector.alias("v"), number.alias("y"), F.xxhash64(F.col(key).cast("string")).alias("k"), (F.col(fold).cast("int") if fold else F.lit(-2)).alias("f"))
    rows = rows.filter("y IS NOT NULL AND v IS NOT NULL")
    edges = bin_edges(rows, "v")
    n_fits, width = len(fits), len(edges)
    if not width:
        return Model(df.sparkSession.createDataFrame([], MODEL), edges, fits)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(start, BLOCK_ROWS)
                n = batch.num_rows
                y, k, f = (np.asarray(batch.column(c)) for c in ("y", "k", "f"))
                parts = [binned(matrix_of(batch.column("v"), width), edges), n, y.astype(np.int8), k.astype(np.int64), f.astype(np.int32), np.zeros(0)]
                values = [pa.array([p if isinstance(p, int) else np.ascontiguousarray(p).tobytes()], pa.int32() if isinstance(p, int) else pa.binary()) for p in parts]
                yield pa.RecordBatch.from_arrays(values, names=[c.split()[0] for c in BLOCK.split(", ")])

    blocks = cut_lineage(rows.mapInArrow(pack, BLOCK))
    n = blocks.agg(F.sum("n")).head()[0] or 0
    spark = df.sparkSession
    if n * width > in_task:
        return Model(spark.createDataFrame(model_rows(grown_by_levels(blocks, fits)), MODEL), edges, fits)

    work = parts_of(fits)

    def part(key_, pdf):
        import pandas as pd

        parts = [unpacked(row, n_fits)[:4] for row in pdf.to_dict("records")]
        here = [np.concatenate(p) for p in zip(*parts)]
        rows_ = [row for i, numbers in work[int(key_[0])] for row in model_rows(grown_here(fits, i, numbers, *here))]
        return pd.DataFrame(rows_, columns=[c.split()[0] for c in MODEL.split(", ")])

    # The parts are dealt by number, not by hash.
    each = blocks.drop("margin").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(len(work) - 1))))
    dealt = each.repartitionByRange(min(len(work), 1000), "part")
    return Model(cut_lineage(dealt.groupBy("part").applyInPandas(part, MODEL)), edges, fits)


@dataclass
class Model:
    """Trees as rows, and the edges of the bins. The trees are bounded by their number and depth."""

    rows: DataFrame
    edges: np.ndarray
    fits: list[TreeFit]

    def packed(self) -> DataFrame:
        """(fit, tree, nodes, body): a tree as arrays in one row."""

        def pack(key, pdf):
            import pandas as pd

            pdf = pdf.sort_values("node")
            node = pdf["node"].to_numpy(np.int64)
            inner = pdf["feature"].to_numpy(np.int32)
            left = np.where(inner >= 0, np.searchsorted(node, 2 * node), 0).astype(np.int32)
            parts = inner, left, pdf["cut"].to_numpy(np.int32).clip(0).astype(np.uint8), pdf["value"].to_numpy(np.float64)
            return pd.DataFrame({"fit": [key[0]], "tree": [key[1]], "nodes": [len(node)], "body": [b"".join(p.tobytes() for p in parts)]})

        return self.rows.groupBy("fit", "tree").applyInPandas(pack, "fit int, tree int, nodes int, body binary")

    def predict(self, df: DataFrame, vec_col: str, out: str = "scores") -> DataFrame:
        """`df` with the probability of label 1 by each fit, as an array.

        Trees are sent to the tasks by WAVE nodes, and the sums are written between the waves, so
        neither the driver nor a task holds all trees.
        """
        edges, fits, spark = self.edges, self.fits, df.sparkSession
        trees_ = cut_lineage(self.packed())
        sizes = trees_.select("fit", "tree", "nodes").orderBy("fit", "tree").collect()
        waves: list[list] = []
        held = WAVE
        for r in sizes:
            if held + r["nodes"] > WAVE:
                waves.append([])
                held = 0
            waves[-1].append((r["fit"], r["tree"]))
            held += r["nodes"]
        vector = F.col(vec_col).cast("array<double>")
        table = df.withColumn(out, F.array_repeat(F.lit(0.0), len(fits))).withColumn("_v", vector)
        tree = F.struct("fit", "tree")
        for number, wave in enumerate(waves or [[]]):
            ends = (F.struct(F.lit(f).cast("int").alias("fit"), F.lit(t).cast("int").alias("tree")) for f, t in (wave[0], wave[-1])) if wave else ()
            found = trees_.filter(tree.between(*ends)).orderBy("fit", "tree").collect() if wave else []
            sent = spark.sparkContext.broadcast([(r["fit"], r["nodes"], bytes(r["body"])) for r in found])
            del found
            last = number + 1 >= len(waves)

            def run(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    names = batch.schema.names
                    at, v = names.index(out), names.index("_v")
                    bins = binned(matrix_of(batch.column(v), len(edges)), edges)
                    sums = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(len(bins), len(fits)).copy()
                    for i, n, body in sent.value:
                        sums[:, i] += packed_values(n, body, bins)
                    if last:
                        for i, fit in enumerate(fits):
                            sums[:, i] = 1 / (1 + np.exp(-sums[:, i])) if fit.kind == "boost" else sums[:, i] / fit.trees
                    scores = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), len(fits)).cast(pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([*batch.columns[:at], scores, *batch.columns[at + 1 :]], names=names)

            table = table.mapInArrow(run, table.schema)
            if not last:
                table = cut_lineage(table)
                sent.unpersist()
        return table.drop("_v")


def packed_values(n: int, body: bytes, bins: np.ndarray) -> np.ndarray:
    """The value that each row gets from a packed tree."""
    feature, left = np.frombuffer(body, np.int32, 2 * n).reshape(2, n)
    cut, value = np.frombuffer(body, np.uint8, n, 8 * n), np.frombuffer(body[9 * n :], np.float64)
    at = np.zeros(len(bins), np.int64)
    rows = np.flatnonzero(feature[at] >= 0)
    while len(rows):
        node = at[rows]
        at[rows] = left[node] + (bins[rows, feature[node]] > cut[node])
        rows = rows[feature[at[rows]] >= 0]
    return value[at]


def predicted(score: Column) -> Column:
    """Label 1 from one half on, as a number."""
    return (score >= 0.5).cast("double")
