"""Linear classifiers fitted together: every fold, penalty and set of columns is a fit of its own.

A step is one Spark job for all fits: every block of rows gives the loss and gradient of each fit
at the point where that fit stands, and every task adds them up by fit. A fit is a chain of such points
(L-BFGS with halved steps), so that fits that are done take no further part. What comes to the
driver is one gradient a fit and task, of which there are no more than cores, whatever the number of rows.

The objective is the sum of the losses plus |w|² / (2 c); the intercept is free of the penalty. The
hinge is rounded off below the margin over a width that shrinks from stage to stage, to `WIDTHS[-1]`;
the loss of a row then differs from the plain hinge by half of that at most.

Defined cases: features without a value count as 0; rows without a label or a vector are not fitted;
with rows of one label only, or none, the intercept stops after the given number of steps.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.models.trees import matrix_of
from versemill.session import cut_lineage

#: Cells (rows times features) of a block.
BLOCK_CELLS = 4_000_000
#: Widths over which the hinge is rounded off, one after the other, and how much of the tolerance each takes.
WIDTHS, LOOSER = (0.5, 0.05, 0.005), (1000, 1000, 10)
#: Earlier steps that L-BFGS keeps.
MEMORY = 10
BLOCK = "n int, x binary, label binary, fold binary"


@dataclass(frozen=True)
class LineFit:
    """One fit: `logistic` or `hinge` loss, inverse penalty, columns (all where none are named) and
    the fold whose rows are not fitted."""

    loss: str = "logistic"
    c: float = 1.0
    columns: tuple[int, ...] | None = None
    left_out: int = -1


def losses(fit: LineFit, width: float, margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss of each row and its slope along the margin (labels 0 and 1)."""
    if fit.loss == "logistic":
        return np.logaddexp(0, margin) - y * margin, 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y
    sign = 2 * y - 1
    gap = 1 - sign * margin
    inside = (gap > 0) & (gap < width)
    value = np.where(inside, gap * gap / (2 * width), np.maximum(gap - width / 2, 0) * (gap > 0))
    return value, -sign * np.where(inside, gap / width, gap >= width)


def used_columns(fit: LineFit, n: int) -> np.ndarray:
    used = np.zeros(n, bool)
    used[list(range(n) if fit.columns is None else fit.columns)] = True
    return used


Asked = Generator[tuple[float, np.ndarray], tuple[float, np.ndarray], np.ndarray]


def descent(start: np.ndarray, width: float, tolerance: float, steps: int) -> Asked:
    """L-BFGS as a chain of questions: yields (width, point), is sent (value, gradient) there, and
    returns the last point. It ends where no slope is above the tolerance or no step gains."""
    x = start
    value, slope = yield width, x
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(slope).max() <= tolerance:
            break
        way, parts = -slope, []
        for s, g in reversed(held):
            a = (s @ way) / (s @ g)
            parts.append(a)
            way = way - a * g
        if held:
            s, g = held[-1]
            way = way * ((s @ g) / (g @ g))
        for (s, g), a in zip(held, reversed(parts)):
            way = way + (a - (g @ way) / (s @ g)) * s
        step = 1.0 if held else 1 / max(1.0, np.linalg.norm(slope))
        while True:
            there = x + step * way
            new_value, new_slope = yield width, there
            if new_value <= value + 1e-4 * step * (way @ slope) + 1e-13 * abs(value):
                break
            step /= 2
            if step < 1e-12:
                return x
        s, g = there - x, new_slope - slope
        if s @ g > 1e-14 * (g @ g):
            held = [*held, (s, g)][-MEMORY:]
        x, value, slope = there, new_value, new_slope
    return x


def stages(fit: LineFit, n: int, tolerance: float, steps: int) -> Asked:
    x = np.zeros(n + 1)
    for width, looser in zip(WIDTHS, LOOSER) if fit.loss == "hinge" else [(1.0, 1)]:
        x = yield from descent(x, width, looser * tolerance, steps)
    return x


def packed_rows(df: DataFrame, vec_col: str, label: str, fold: str | None, cells: int = BLOCK_CELLS) -> tuple[DataFrame, int]:
    """Blocks of rows as written matrices of up to `cells` numbers, and the number of features."""
    rows = df.select(
        F.col(vec_col).cast("array<double>").alias("v"), F.col(label).cast("int").alias("y"), (F.col(fold).cast("int") if fold else F.lit(-2)).alias("f")
    ).filter("y IS NOT NULL AND v IS NOT NULL AND f IS NOT NULL")
    first = rows.select(F.size("v").alias("n")).head()
    n = first["n"] if first else 0
    size = max(1, cells // max(n, 1))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, size):
                batch = whole.slice(start, size)
                parts = [matrix_of(batch.column("v"), n), *(np.asarray(batch.column(c)).astype(np.int32) for c in ("y", "f"))]
                values = [pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts]
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int32()), *values], names=["n", "x", "label", "fold"])

    return cut_lineage(rows.mapInArrow(pack, BLOCK)), n


def slopes_at(blocks: DataFrame, fits: list[LineFit], asked: dict[int, tuple[float, np.ndarray]], n: int) -> dict[int, np.ndarray]:
    """Fit → (sum of losses, slopes of the weights, slope of the intercept) over its rows: one job."""
    numbers = sorted(asked)
    points = np.stack([asked[i][1] for i in numbers], 1)
    widths = [asked[i][0] for i in numbers]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(numbers), n + 2))
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["x"], np.float64).reshape(row["n"], n)
                y, fold = (np.frombuffer(row[c], np.int32) for c in ("label", "fold"))
                margins = x @ points[:-1] + points[-1]
                slopes = np.zeros_like(margins)
                for j, i in enumerate(numbers):
                    kept = fold != fits[i].left_out
                    value, slope = losses(fits[i], widths[j], margins[:, j], y)
                    total[j, 0] += value[kept].sum()
                    slopes[:, j] = slope * kept
                total[:, 1:-1] += slopes.T @ x
                total[:, -1] += slopes.sum(0)
        parts = [pa.array(numbers, pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())]
        yield pa.RecordBatch.from_arrays(parts, names=["fit", "sums"])

    # As many partial sums come to the driver as cores, whatever the number of rows.
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    found = blocks.coalesce(cores).mapInArrow(sums, "fit int, sums binary").collect()
    out = {i: np.zeros(n + 2) for i in numbers}
    for r in found:
        out[r["fit"]] += np.frombuffer(r["sums"], np.float64)
    return out


def fit_lines(
    df: DataFrame, fits: list[LineFit], vec_col: str, label: str, key: str | None = None, fold: str | None = None, tolerance: float = 1e-6, steps: int = 1000
) -> LineModel:
    """All fits on the rows of `df` (labels 0 and 1, `fold` numbers from 0). The tolerance is that of
    the mean slope of a row (ten times that for the hinge); `key` is taken for the sake of one signature with trees, and not used."""
    blocks, n = packed_rows(df, vec_col, label, fold)
    rows = blocks.agg(F.sum("n")).head()[0] or 0
    used = [used_columns(fit, n) for fit in fits]
    chains = {i: stages(fit, n, tolerance * max(rows, 1), steps) for i, fit in enumerate(fits)}
    asked = {i: next(chain) for i, chain in chains.items()}
    weights = np.zeros((len(fits), n + 1))
    while asked:
        found = slopes_at(blocks, fits, asked, n)
        nearer = {}
        for i, (_, point) in asked.items():
            w, slope = point[:-1], found[i][1:].copy()
            slope[:-1] = np.where(used[i], slope[:-1] + w / fits[i].c, 0.0)
            try:
                nearer[i] = chains[i].send((found[i][0] + w @ w / (2 * fits[i].c), slope))
            except StopIteration as end:
                weights[i] = end.value
        asked = nearer
    return LineModel(weights, fits)


def scored(df: DataFrame, vec_col: str, out: str, n_features: int, score: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """`df` with an array of scores that `score` gives for a matrix of rows."""
    rows = df.withColumn(out, F.coalesce(F.col(vec_col).cast("array<double>"), F.array_repeat(F.lit(0.0), n_features)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(out)
            found = score(matrix_of(batch.column(at), n_features))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], lists, *batch.columns[at + 1 :]], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


@dataclass
class LineModel:
    """[fit, feature] weights with the intercept last."""

    weights: np.ndarray
    fits: list[LineFit]

    def predict(self, df: DataFrame, vec_col: str, out: str = "scores") -> DataFrame:
        """`df` with an array of one score a fit, from one half on label 1: the probability by a
        logistic fit; for a hinge the margin put through the same curve. No vector counts as zeros."""
        weights = self.weights
        score = lambda x: 1 / (1 + np.exp(-np.clip(x @ weights[:, :-1].T + weights[:, -1], -500, 500)))
        return scored(df, vec_col, out, weights.shape[1] - 1, score)
