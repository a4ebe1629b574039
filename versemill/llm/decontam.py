"""Benchmark decontamination by latent semantic retrieval.

Words are hashed to FEATURES and weighted by their document frequency over all documents. A
randomised SVD of the TF-IDF passages of all benchmark items and all documents gives a latent
space; every document is cut into overlapping windows of three lengths, and every
window is compared with the items of its length by cosine. What passes is verified on the words:
the longest common subsequence with the item, and for paraphrases also with the item's answer.

The documents are read whole and stay where they are: neither search nor check shuffles them. Their
features are written once, two bytes a word, for the three passes that fit the space.
Items are taken in blocks of ITEM_BLOCK; the factor that is sent to the tasks has a fixed size.

Defined cases: absent and empty texts have no leaks; items of fewer than MIN_ITEM words are never
found; equal items are found each under its own id; repeated rows are searched as often as they
occur; no items or no documents give no leaks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.llm.common import appended, encoded, pieces, schema_with, without
from versemill.session import cut_lineage

FEATURE_BITS = 15
FEATURES = 1 << FEATURE_BITS
RANK = 64
OVERSAMPLE = 8
#: Power of the singular values that is taken out of the directions.
FLATTEN = 0.75
SEED = 11
#: Words a passage. The space is fitted on all passages of all texts, so many at a time.
PASSAGE = 64
PASSAGES_AT_ONCE = 4096
ITEM_BLOCK = 5000
#: Tokens a cell; windows are runs of 2, 4 and 8 cells, each starting at every half length.
CELL = 8
SCALES = (2, 4, 8)
CELLS_AT_ONCE = 4096
MIN_COSINE = 0.5
MIN_ITEM = 5
#: Share of an item's words that a document has in order: a copy, and a paraphrase.
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
LEAKS = "array<struct<item: long, share: double, answer: double, start: long>>"


#: Factors by byte and by place in the word, for hashing all words of a buffer at once.
_rng = np.random.default_rng(5)
BYTES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
PLACES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BLANK = np.zeros(256, bool)
BLANK[list(b" \t\n\x0b\x0c\r")] = True
#: Documents whose features are marked at once when they are counted.
MARKED = 256


class Words:
    """The words of lower-cased texts: their features, their places in `joined`, and the number of
    the first word of each text (and of the end)."""

    def __init__(self, texts: list[bytes]):
        self.joined = b" ".join(texts).lower() + b" "
        raw = np.frombuffer(self.joined, np.uint8)
        inside = np.concatenate([[False], ~BLANK[raw], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        self.first = np.searchsorted(self.starts, begins)
        lengths = self.ends - self.starts
        if not len(lengths):
            self.features = np.zeros(0, np.int64)
            return
        at = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
        mixed = BYTES[raw[inside[1:-1]]] * PLACES[place & 255]
        key = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), at)
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        self.features = (key >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)

    def words(self, a: int, b: int) -> list[bytes]:
        return [self.joined[x:y] for x, y in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of the words of each text, two bytes each."""
    for batch in batches:
        texts, item = encoded(batch.column("text")), batch.column("item")
        for a, b in pieces(texts):
            words = Words(texts[a:b])
            flat, first = words.features.astype(np.uint16), words.first.tolist()
            held = [flat[x:y].tobytes() for x, y in zip(first, first[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), item.slice(a, b - a)], names=["features", "item"])


def _flat(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features of all words, words of each text, whether it is an item) of some texts at a time."""
    held, item = batch.column("features").to_pylist(), np.asarray(batch.column("item"))
    for a, b in pieces(held):
        counts = np.array([len(f) // 2 for f in held[a:b]])
        yield np.frombuffer(b"".join(held[a:b]), np.uint16).astype(np.int64), counts, item[a:b]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(FEATURES, np.int64)
    mark = np.zeros((MARKED, FEATURES), bool)
    for batch in batches:
        for flat, counts, _ in _flat(batch):
            first = np.concatenate([[0], np.cumsum(counts)])
            for c in range(0, len(counts), MARKED):
                part = first[c : min(c + MARKED, len(counts)) + 1]
                owner = np.repeat(np.arange(len(part) - 1), np.diff(part))
                mark[:] = False
                mark[owner, flat[part[0] : part[-1]]] = True
                held += np.count_nonzero(mark, axis=0)
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], names=["feature", "n"])


def inverse_frequencies(features: DataFrame, documents: int) -> np.ndarray:
    """Weight of every feature, from all documents (FEATURES numbers)."""
    counts = features.mapInArrow(_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    held = np.zeros(FEATURES)
    for row in counts.collect():
        held[row["feature"]] = row["n"]
    return np.log((documents + 1) / (held + 0.5)).clip(0)


def drawn_columns() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((FEATURES, RANK + OVERSAMPLE), np.float32)


def _passages(batches: Iterator[pa.RecordBatch], idf: np.ndarray, item_weight: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Some passages at a time, as rows of PASSAGE words: their features (FEATURES where a passage is
    shorter) and the weights of the words, of length 1 a passage or `item_weight`."""
    weight = np.append(idf, 0.0)
    for batch in batches:
        for flat, counts, item in _flat(batch):
            n = -(-counts // PASSAGE)
            place = np.arange(len(flat)) + np.repeat(PASSAGE * (np.cumsum(n) - n) - (np.cumsum(counts) - counts), counts)
            every = np.full(int(n.sum()) * PASSAGE, FEATURES, np.int64)
            every[place] = flat
            every, of_item = every.reshape(-1, PASSAGE), np.repeat(item, n)
            for start in range(0, len(every), PASSAGES_AT_ONCE):
                at = np.sort(every[start : start + PASSAGES_AT_ONCE].astype(np.int32), axis=1)
                # A feature counts by the square of all its weight in the passage.
                new = np.ones(at.shape, bool)
                new[:, 1:] = at[:, 1:] != at[:, :-1]
                runs = np.flatnonzero(new)
                tf = np.diff(np.append(runs, at.size))
                length = np.sqrt(np.bincount(runs // PASSAGE, (tf * weight[at.ravel()[runs]]) ** 2, len(at)))
                size = np.where(of_item[start : start + len(at)], item_weight, 1.0)
                factor = np.divide(size, length, out=np.zeros(len(at)), where=length > 0)
                yield at.astype(np.int64), weight[at] * factor[:, None]


def _times(at: np.ndarray, x: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Passages x factor (FEATURES + 1 rows), a row a passage."""
    out = np.empty((len(at), factor.shape[1]), np.float32)
    x = x.astype(np.float32)[:, None, :]
    for a in range(0, len(at), MARKED):
        out[a : a + MARKED] = np.matmul(x[a : a + MARKED], np.take(factor, at[a : a + MARKED], axis=0))[:, 0]
    return out


def _padded(basis: np.ndarray) -> np.ndarray:
    return np.concatenate([basis.astype(np.float32), np.zeros((1, basis.shape[1]), np.float32)])


def _gram_drawn(idf: np.ndarray, item_weight: float, parts: int):
    """Passages → A'A x random columns, summed over the task, in row blocks. Each task draws the
    columns again instead of getting them sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = _padded(drawn_columns())
        out = np.zeros((factor.shape[1], FEATURES + 1))
        for at, x in _passages(batches, idf, item_weight):
            flat = at.ravel()
            for column, held in zip(out, _times(at, x, factor).T.astype(np.float64)):
                column += np.bincount(flat, (x * held[:, None]).ravel(), FEATURES + 1)
        size = FEATURES // parts
        sums = [np.ascontiguousarray(out[:, i * size : (i + 1) * size].T, np.float32).tobytes() for i in range(parts)]
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array(sums, pa.binary())], names=["part", "sums"])

    return run


def gram_drawn(features: DataFrame, idf: np.ndarray, item_weight: float, parts: int = 32) -> np.ndarray:
    """A'A x random columns over all passages: tasks add up their own, then blocks of rows are added."""
    import pandas as pd

    def add(key, pdf):
        total = sum(np.frombuffer(s, np.float32).astype(np.float64) for s in pdf["sums"])
        return pd.DataFrame({"part": [key[0]], "sums": [total.astype(np.float32).tobytes()]})

    width = RANK + OVERSAMPLE
    own = features.mapInArrow(_gram_drawn(idf, item_weight, parts), "part int, sums binary")
    rows = own.groupBy("part").applyInPandas(add, "part int, sums binary").collect()  # FEATURES x width numbers
    out = np.zeros((FEATURES, width))
    size = FEATURES // parts
    for row in rows:
        out[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(row["sums"], np.float32).reshape(size, width)
    return out


def gram_within(features: DataFrame, basis: np.ndarray, idf: np.ndarray, item_weight: float) -> np.ndarray:
    """basis' A'A basis over all passages, a small square matrix: no sum by feature is needed for it."""
    sent = features.sparkSession.sparkContext.broadcast(basis.astype(np.float32))
    width = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, out = _padded(sent.value), np.zeros((width, width))
        for at, x in _passages(batches, idf, item_weight):
            held = _times(at, x, factor)
            out += held.T @ held
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

    rows = features.mapInArrow(run, "sums binary").collect()
    sent.destroy()
    return sum((np.frombuffer(r["sums"]) for r in rows), np.zeros(width * width)).reshape(width, width)


def randomised_svd(features: DataFrame, idf: np.ndarray, item_weight: float) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors, singular values) of the weighted passages.

    The range of A'A is sampled with random columns; the small matrix of A'A within it gives
    vectors and values (Rayleigh-Ritz).
    """
    basis = np.linalg.qr(gram_drawn(features, idf, item_weight))[0]
    small = gram_within(features, basis, idf, item_weight)
    values, turns = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:RANK]
    return basis @ turns[:, order], np.sqrt(values[order].clip(0))


def fit_space(docs: DataFrame, items: DataFrame) -> np.ndarray:
    """(doc text, item text) → weights of every feature in the latent space, FEATURES x RANK.

    Directions are divided by a power of their singular values, so that what all texts of a
    language share does not make up the cosine, and the rarest directions do not either.
    """
    both = docs.select("text", F.lit(False).alias("item")).unionByName(items.select("text", F.lit(True).alias("item")))
    features = cut_lineage(both.mapInArrow(_features, "features binary, item boolean"))
    n_passages = F.sum(F.ceil(F.octet_length("features") / (2 * PASSAGE)))
    counts = {r["item"]: (r["n"], r["passages"]) for r in features.groupBy("item").agg(F.count("*").alias("n"), n_passages.alias("passages")).collect()}
    (n, of_docs), (_, of_items) = counts.get(False, (0, 0)), counts.get(True, (0, 0))
    idf = inverse_frequencies(features.filter("NOT item"), n)
    # Items weigh as much as the documents together.
    item_weight = np.sqrt(max(1.0, of_docs / max(1, of_items)))
    # What a task sums up has a fixed size, so there are as many tasks as cores can take, not more with more text.
    passages = features.coalesce(2 * features.sparkSession.sparkContext.defaultParallelism)
    vectors, values = randomised_svd(passages, idf, item_weight)
    scaled = np.divide(vectors, values**FLATTEN, out=np.zeros_like(vectors), where=values > 1e-6 * max(values.max(initial=0), 1e-12))
    return (idf[:, None] * scaled).astype(np.float32)


def lcs(words: list[bytes], masks: dict[bytes, int], length: int) -> int:
    """Longest common subsequence with the item that `masks` describes, a word at a time on bits."""
    full = (1 << length) - 1
    rows = full
    for word in words:
        m = masks.get(word)
        if m:
            x = rows & m
            rows = ((rows + x) | (rows - x)) & full
    return length - rows.bit_count()


def answer_words(text: bytes) -> list[bytes]:
    """The item's last sentence, or the last quarter of its words if it has only one."""
    sentences = [s.split() for s in re.split(rb"(?<=[.?!])\s+|\n+", text.strip()) if s.strip()]
    words = text.split()
    if len(sentences) > 1 and len(sentences[-1]) >= 2:
        return sentences[-1]
    return words[-max(3, len(words) // 4) :]


class Items:
    """Words, masks and latent directions of a block of items, by scale."""

    def __init__(self, rows: list[tuple[int, bytes]], space: np.ndarray):
        self.entries = []
        self.by_scale: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        at: dict[int, list[int]] = {s: [] for s in SCALES}
        directions = []
        for item, text in rows:
            lowered = text.lower()
            words = lowered.split()
            if len(words) < MIN_ITEM:
                continue
            features = Words([text]).features
            scale = next((s for s in SCALES if len(words) < 1.5 * s * CELL), SCALES[-1])
            answer = answer_words(lowered)
            # A long item is found by any of its passages.
            size = scale * CELL if scale == SCALES[-1] else len(words)
            for start in range(0, max(1, len(words) - size // 2), size):
                v = space[features[start : start + size]].sum(0)
                norm = np.sqrt(v @ v)
                if norm > 0:
                    at[scale].append(len(self.entries))
                    directions.append((scale, v / norm))
            self.entries.append((item, len(words), frozenset(features.tolist()), self._masks(words), len(answer), self._masks(answer)))
        for scale in SCALES:
            rows_of = [v for s, v in directions if s == scale]
            if rows_of:
                self.by_scale[scale] = (np.array(at[scale]), np.array(rows_of, np.float32))

    @staticmethod
    def _masks(words: list[bytes]) -> dict[bytes, int]:
        masks: dict[bytes, int] = {}
        for i, word in enumerate(words):
            masks[word] = masks.get(word, 0) | (1 << i)
        return masks


def candidates(cells: np.ndarray, space: np.ndarray, items: Items) -> Iterator[tuple[int, int, int]]:
    """(first cell, scale, entry) of windows that are near an item. `cells` has CELL features each."""
    reach = SCALES[-1] - 1
    for start in range(0, len(cells), CELLS_AT_ONCE):
        part = cells[start : start + CELLS_AT_ONCE + reach]
        sums = space[part.ravel()].reshape(len(part), CELL, -1).sum(1)
        sums = np.concatenate([sums, np.zeros((reach, sums.shape[1]), np.float32)])
        upto = min(CELLS_AT_ONCE, len(cells) - start)
        run, length = sums, 1
        for scale in SCALES:
            while length < scale:
                run = run[: len(run) - length] + run[length:]
                length *= 2
            if scale not in items.by_scale:
                continue
            entries, directions = items.by_scale[scale]
            at = np.arange(-start % (scale // 2), upto, scale // 2)
            windows = run[at]
            norms = np.sqrt(np.einsum("ij,ij->i", windows, windows))
            near = windows @ directions.T >= MIN_COSINE * np.maximum(norms, 1e-12)[:, None]
            for i, j in zip(*np.nonzero(near)):
                yield start + int(at[i]), scale, int(entries[j])


def find_leaks(texts: list[bytes], space: np.ndarray, items: Items) -> list[list[dict]]:
    """For each text its leaks, the best place of each item."""
    words = Words(texts)
    counts = np.diff(words.first)
    n_cells = -(-counts // CELL)
    first = np.concatenate([[0], np.cumsum(n_cells)])
    flat = np.full(int(first[-1]) * CELL, FEATURES, np.int64)  # the row after the last one is 0
    # Every text starts a new cell.
    flat[np.arange(len(words.features)) + np.repeat(first[:-1] * CELL - words.first[:-1], counts)] = words.features
    found: list[dict[int, dict]] = [{} for _ in texts]
    tried: set[tuple[int, int, int]] = set()
    for cell, scale, entry in candidates(flat.reshape(-1, CELL), space, items):
        item, length, wanted, masks, answer_length, answer_masks = items.entries[entry]
        margin = length if length > scale * CELL else length // 2
        d = int(np.searchsorted(first, cell, "right")) - 1
        while d < len(texts) and first[d] < cell + scale:
            place = (cell - int(first[d])) * CELL
            a, b = max(0, place - margin), min(int(counts[d]), place + scale * CELL + margin)
            if b > a and (d, entry, a) not in tried:
                tried.add((d, entry, a))
                begin = int(words.first[d])
                # No subsequence is longer than the words that have a feature of the item.
                some = sum(map(wanted.__contains__, words.features[begin + a : begin + b].tolist())) >= PARAPHRASE * length
                held = words.words(begin + a, begin + b) if some else []
                share = lcs(held, masks, length) / length
                if share >= PARAPHRASE:
                    answer = lcs(held, answer_masks, answer_length) / answer_length
                    old = found[d].get(item)
                    if (share >= COPY or answer >= ANSWER) and (old is None or share > old["share"]):
                        found[d][item] = {"item": item, "share": share, "answer": answer, "start": a}
            d += 1
    return [[f[i] for i in sorted(f)] for f in found]


def _search(space_of, items_of):
    kind = pa.list_(pa.struct([("item", pa.int64()), ("share", pa.float64()), ("answer", pa.float64()), ("start", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = np.concatenate([space_of.value, np.zeros((1, RANK), np.float32)])
        items = Items(items_of, space)
        for batch in batches:
            texts = encoded(batch.column("_searched"))
            new = [leaks for a, b in pieces(texts, 2_000_000) for leaks in find_leaks(texts[a:b], space, items)]
            held = [x + y for x, y in zip(batch.column("leaks").to_pylist(), new)]
            rest = batch.drop_columns(["leaks"])
            yield appended(rest, leaks=pa.array(held, kind))

    return run


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of `docs` and `leaks`: the items found in the text, with the share of
    the item's words that stand there in order, the same for its answer, and the place (in words)."""
    kept = without(docs, "leaks")
    items = benchmark.select(F.col("item_id").alias("id"), F.col("text").cast("string").alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    space = docs.sparkSession.sparkContext.broadcast(fit_space(kept.select(F.col(text).cast("string").alias("text")), items))
    out = kept.withColumn("_searched", F.col(text).cast("string")).withColumn("leaks", F.array().cast(LEAKS))
    schema = schema_with(out.drop("leaks"), f"leaks {LEAKS}")
    block: list[tuple[int, bytes]] = []
    for row in items.toLocalIterator():
        block.append((row["id"], row["text"].encode()))
        if len(block) == ITEM_BLOCK:
            out = out.mapInArrow(_search(space, block), schema)
            block = []
    if block:
        out = out.mapInArrow(_search(space, block), schema)
    return out.drop("_searched")
