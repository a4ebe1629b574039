"""Nets of dense layers fitted together: every net is a fit of its own.

A step is one Spark job for all nets: a task adds up loss and slopes of its blocks of rows as
products of matrices, and Spark adds up the sums of the tasks by net and piece of the weights. A net
is a chain of such points (L-BFGS, as for linear fits), which begins anew at each stage. There are as
many partial sums as cores, whatever the number of rows.

Hidden layers are logistic, the last one is softmax; the objective is the mean cross-entropy.
Defined cases: features without a value count as 0; rows without a label or a vector are not fitted.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.models.lines import Asked, descent, packed_rows
from versemill.models.trees import matrix_of
from versemill.operators import metrics
from versemill.session import cut_lineage

#: Rows that are multiplied at once, and weights of a piece that one task adds up.
ROWS_AT_ONCE, PIECE = 2048, 1 << 16


def layers_of(point: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, offsets) of each layer, as views of one array."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((point[at : at + a * b].reshape(a, b), point[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def first_weights(sizes: list[int], seed: int) -> np.ndarray:
    """Uniform weights whose width falls with the inputs of a layer, as for logistic layers usual."""
    rng = np.random.default_rng(seed)
    return np.concatenate([(rng.random(a * b + b) * 4.8 - 2.4) / a for a, b in zip(sizes, sizes[1:])])


def outputs(point: np.ndarray, sizes: list[int], x: np.ndarray) -> list[np.ndarray]:
    """The rows, what each hidden layer makes of them, and the last sums before softmax."""
    out = [x]
    layers = layers_of(point, sizes)
    for i, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        out.append(z if i + 1 == len(layers) else 1 / (1 + np.exp(-np.clip(z, -500, 500))))
    return out


def loss_and_slopes(point: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum of the losses of some rows, then its slopes in the order of the weights."""
    total = np.zeros(len(point) + 1)
    made, slopes = outputs(point, sizes, x), layers_of(total[1:], sizes)
    last = made[-1] - made[-1].max(1, keepdims=True)
    share = np.exp(last)
    sums = share.sum(1, keepdims=True)
    rows = np.arange(len(x))
    total[0] = (np.log(sums[:, 0]) - last[rows, y]).sum()
    back = share / sums
    back[rows, y] -= 1
    layers = layers_of(point, sizes)
    for i in range(len(layers) - 1, -1, -1):
        slopes[i][0][:] = made[i].T @ back
        slopes[i][1][:] = back.sum(0)
        if i:
            back = (back @ layers[i][0].T) * made[i] * (1 - made[i])
    return total


def sums_at(blocks: DataFrame, sizes: dict[str, list[int]], asked: dict[str, np.ndarray], n: int) -> dict[str, np.ndarray]:
    """Net → sum of losses and slopes at the point asked for: one job."""
    sent = blocks.sparkSession.sparkContext.broadcast(asked)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = sent.value
        total = {net: np.zeros(len(point) + 1) for net, point in points.items()}
        for batch in batches:
            for row in batch.to_pylist():
                x, y = np.frombuffer(row["x"], np.float64).reshape(row["n"], n), np.frombuffer(row["label"], np.int32)
                for a in range(0, len(x), ROWS_AT_ONCE):
                    for net, point in points.items():
                        total[net] += loss_and_slopes(point, sizes[net], x[a : a + ROWS_AT_ONCE], y[a : a + ROWS_AT_ONCE])
        for net, whole in total.items():
            starts = range(0, len(whole), PIECE)
            parts = [pa.array([net] * len(starts)), pa.array(range(len(starts)), pa.int32()), pa.array([whole[a : a + PIECE].tobytes() for a in starts], pa.binary())]
            yield pa.RecordBatch.from_arrays(parts, names=["net", "piece", "sums"])

    def added(key, pdf):
        import pandas as pd

        whole = sum(np.frombuffer(s, np.float64) for s in pdf["sums"])
        return pd.DataFrame({"net": [key[0]], "piece": [key[1]], "sums": [whole.tobytes()]})

    kind = "net string, piece int, sums binary"
    found = blocks.mapInArrow(sums, kind).groupBy("net", "piece").applyInPandas(added, kind).collect()
    sent.destroy()
    out = {net: np.zeros(len(point) + 1) for net, point in asked.items()}
    for r in found:
        part = np.frombuffer(r["sums"], np.float64)
        out[r["net"]][r["piece"] * PIECE : r["piece"] * PIECE + len(part)] = part
    return out


@dataclass
class Net:
    """Sizes of the layers and all weights in one array; label 1 where its sum is above that of 0."""

    sizes: list[int]
    weights: np.ndarray
    features: str = "features"

    def getLayers(self) -> list[int]:  # the name it has in MLlib's model
        return self.sizes

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with `prediction`."""
        sizes, n = self.sizes, self.sizes[0]
        sent = df.sparkSession.sparkContext.broadcast(self.weights)
        zeros = F.array_repeat(F.lit(0.0), n)
        rows = df.withColumn("prediction", F.lit(0.0)).withColumn("_v", F.coalesce(vector_to_array(self.features), zeros))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix_of(batch.column("_v"), n)
                said = np.zeros(len(x))
                for a in range(0, len(x), ROWS_AT_ONCE):
                    said[a : a + ROWS_AT_ONCE] = outputs(sent.value, sizes, x[a : a + ROWS_AT_ONCE])[-1].argmax(1)
                at = batch.schema.get_field_index("prediction")
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(said), *batch.columns[at + 1 :]], names=batch.schema.names)

        return rows.mapInArrow(run, rows.schema).drop("_v")


def stages(net: Net, validation: DataFrame, label: str, steps: int, iterations: int, stop_at: float) -> Generator:
    """The best stage of a net by F1 on the validation part, as a chain of questions."""
    best, best_f1 = net, -1.0
    for _ in range(steps):
        weights: np.ndarray = yield from _points(net.weights, iterations)
        net = Net(net.sizes, weights, net.features)
        scored = net.transform(validation.select(label, net.features))
        f1 = metrics.binary_metrics(scored, label, "prediction").head()["f1"]
        if f1 > best_f1:
            best, best_f1 = net, f1
        if f1 >= stop_at:
            break
    return best


def _points(start: np.ndarray, iterations: int) -> Asked:
    return (yield from descent(start, 1.0, 1e-6, iterations))


def fit_nets(
    train: DataFrame,
    validation: DataFrame,
    hidden: dict[str, list[int]],
    n_features: int,
    label: str = "label",
    features: str = "features",
    steps: int = 5,
    iterations: int = 20,
    stop_at: float = 0.95,
    seed: int = 42,
) -> dict[str, Net]:
    """Each net the best of several stages by F1 on a validation part, each going on from the last."""
    blocks, n = packed_rows(train.withColumn("_dense", vector_to_array(features)), "_dense", label, None, ROWS_AT_ONCE * n_features)
    # One share of the blocks a core.
    blocks = cut_lineage(blocks.select("n", "x", "label").repartition(train.sparkSession.sparkContext.defaultParallelism))
    rows = blocks.agg(F.sum("n")).head()[0] or 0
    nets = {name: Net([n_features, *inner, 2], first_weights([n_features, *inner, 2], seed), features) for name, inner in hidden.items()}
    if not rows:
        return nets
    chains = {name: stages(net, validation, label, steps, iterations, stop_at) for name, net in nets.items()}
    asked = {name: next(chain)[1] for name, chain in chains.items()}
    while asked:
        found = sums_at(blocks, {name: nets[name].sizes for name in asked}, asked, n)
        asked = {}
        for name, total in found.items():
            try:
                asked[name] = chains[name].send((float(total[0]) / rows, total[1:] / rows))[1]
            except StopIteration as end:
                nets[name] = end.value
    return nets
