"""Texts as blocks of token numbers, and counts of keys that many blocks ask for.

A block holds whole documents of one task: the hashes of its distinct words and, for every token,
the number of its word. It is a tenth of the text's size, so steps that need the tokens again
read blocks. `counted` is the exchange of an aggregate over keys that are hashes: each block sends
its distinct keys, sorted, to the buckets of the key space; a bucket adds up what the blocks sent
and answers each of them in the order of its keys. Keys are distinct in a block, so a frequent key
costs one entry a block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.llm.common import encoded
from versemill.session import cut_lineage

#: Tokens a block (a longer document is a block of its own), and keys a bucket of `counted`.
BLOCK_TOKENS = 2_000_000
BUCKET_KEYS = 1_000_000
#: Ends every document; the hash and number of no word.
END_HASH = np.uint64(0x9E3779B97F4A7C15)
SIX_BYTES = np.uint64(1 << 48)


def squeeze(values: np.ndarray) -> bytes:
    """Numbers from 0 on in their narrowest type, compressed."""
    top = int(values.max()) if len(values) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[data[0]]
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), kind).astype(np.int64)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, of six bytes where all fit."""
    steps = np.diff(keys, prepend=np.uint64(0))
    first = keys[:1].tobytes()
    if len(keys) and (len(keys) == 1 or steps[1:].max() < SIX_BYTES):
        return b"6" + first + np.ascontiguousarray(steps[1:]).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return b"8" + keys.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    if data[:1] == b"8":
        return np.frombuffer(data, np.uint64, offset=1)
    raw = np.frombuffer(data, np.uint8, offset=9).reshape(-1, 6)
    steps = np.zeros((len(raw) + 1, 8), np.uint8)
    steps[0] = np.frombuffer(data, np.uint8, 8, 1)
    steps[1:, :6] = raw
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


def block_rows(batches: Iterator[pa.RecordBatch], most: int, ends: bool) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids, flags, lengths, codes, total = [], [], [], [], 0
    id_kind = None

    def block() -> pa.RecordBatch:
        hashes = np.fromiter(
            (xxhash.xxh3_64_intdigest(w) if w else int(END_HASH) for w in numbers), np.uint64, len(numbers)
        )
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        tokens = place[np.concatenate(codes)] if codes else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(part << 33) + number], pa.int64()),
                pa.array([ids], pa.list_(id_kind)),
                pa.array([flags], pa.list_(pa.bool_())),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([pack_sorted(hashes[order])], pa.binary()),
                pa.array([squeeze(tokens)], pa.binary()),
            ],
            names=["block", "ids", "flags", "lengths", "words", "codes"],
        )

    for batch in batches:
        id_kind = batch.schema.field("id").type
        for key, flag, text in zip(batch.column("id").to_pylist(), batch.column("flag").to_pylist(), encoded(batch.column("text"))):
            words = text.lower().split()
            if ends:
                words.append(b"")
            if total and total + len(words) > most:
                yield block()
                number += 1
                numbers.clear()
                numbers.default_factory = count().__next__
                ids, flags, lengths, codes, total = [], [], [], [], 0
            ids.append(key)
            flags.append(bool(flag))
            lengths.append(len(words))
            codes.append(np.fromiter((numbers[w] for w in words), np.int64, len(words)))
            total += len(words)
    if ids:
        yield block()


def token_blocks(docs: DataFrame, ends: bool, most: int = BLOCK_TOKENS) -> DataFrame:
    """(id, flag, text) rows as written blocks: ids, flags and token counts of the documents, the
    sorted hashes of the words, and each token's place among them. With `ends`, every document
    closes with an end token. A to Z are lower-cased."""
    kind = dict(docs.dtypes)["id"]
    fields = f"block long, ids array<{kind}>, flags array<boolean>, lengths array<long>, words binary, codes binary"
    rows = docs.select("id", "flag", F.col("text").cast("string").alias("text"))
    return cut_lineage(rows.mapInArrow(lambda batches: block_rows(batches, most, ends), fields))


def bucket_bits(keys: int, most: int = BUCKET_KEYS) -> int:
    """So many leading bits that a bucket gets about `most` keys."""
    return max(3, int(np.ceil(np.log2(max(1, keys / most)))))


def requests(blocks: DataFrame, keys_of: Callable[[dict], list[tuple[int, np.ndarray, np.ndarray]]], bits: int) -> DataFrame:
    """One row for each block, kind and bucket with the keys and amounts that `keys_of` gives.

    `keys_of` takes a block's row and returns (kind, sorted distinct keys, amounts).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (np.arange(1, 1 << bits, dtype=np.uint64)) << np.uint64(64 - bits)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                for kind, keys, amounts in keys_of(row):
                    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    held = [(b, x, y) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "kind": pa.array([kind] * len(held), pa.int32()),
                            "bucket": pa.array([b for b, _, _ in held], pa.int32()),
                            "block": pa.array([row["block"]] * len(held), pa.int64()),
                            "keys": pa.array([pack_sorted(keys[x:y]) for _, x, y in held], pa.binary()),
                            "amounts": pa.array([squeeze(amounts[x:y]) for _, x, y in held], pa.binary()),
                        }
                    )

    return blocks.mapInArrow(run, "kind int, bucket int, block long, keys binary, amounts binary")


def _add_up(key, pdf):
    """Answers to all blocks of one bucket; `present` of its first row counts keys above 0."""
    import pandas as pd

    pdf = pdf.sort_values("block")
    held = [unpack_sorted(k) for k in pdf["keys"]]
    keys = np.concatenate(held)
    amounts = np.concatenate([unsqueeze(a) for a in pdf["amounts"]])
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    group = np.cumsum(new) - 1
    sums = np.bincount(group, weights=amounts[order]).astype(np.int64)
    answer = np.empty(len(keys), np.int64)
    answer[order] = sums[group]
    cuts = np.cumsum([len(h) for h in held])[:-1]
    return pd.DataFrame(
        {
            "kind": pdf["kind"].to_numpy(),
            "bucket": pdf["bucket"].to_numpy(),
            "block": pdf["block"].to_numpy(),
            "sums": [squeeze(x) for x in np.split(answer, cuts)],
            "present": [int((sums > 0).sum())] + [0] * (len(held) - 1),
        }
    )


def counted(asked: DataFrame) -> DataFrame:
    """The sums of all amounts of the keys, for each request row (written)."""
    summed = asked.groupBy("kind", "bucket").applyInPandas(
        _add_up, "kind int, bucket int, block long, sums binary, present long"
    )
    return cut_lineage(summed)


def answers_of(pdf) -> dict[int, np.ndarray]:
    """kind → sums in the order of the block's keys, from the answer rows of one block."""
    return {
        int(kind): np.concatenate([unsqueeze(s) for s in rows.sort_values("bucket")["sums"]])
        for kind, rows in pdf.groupby("kind")
    }
