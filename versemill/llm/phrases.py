"""Phrases of two or three words that occur together more often than their parts would.

Mined with a sample: what is frequent in a share of the texts, at a lowered limit, proposes words
and pairs. One pass over all texts then counts, exactly, the proposed phrases and their negative
border: every word, every pair of proposed words, every triple of two proposed pairs. A border
phrase that turns out frequent extends the proposal, and a further pass counts what its new
members open up, until nothing new is frequent. So each phrase whose parts are all frequent has
been counted over all texts, and every frequent phrase is such a one.

Texts are numbered once, as written blocks of one group (language) each: the distinct words and,
for every place, the number of its word. A pass counts inside each block with arrays, and groups
the blocks' counts by Spark. Whether a word or pair is proposed is looked up in a bit map of at
most 2 ** `MOST_BITS` bits, sent to all tasks; where different ones share a bit,
some phrases are counted without need, and all counts stay exact. Words are told apart by 64-bit
hashes while they are counted.

Defined cases: an absent text is empty, an absent group is `und`; phrases do not reach over the
marks that end a piece; repeated rows count as often as they occur; equal scores are ordered by
count and then by the bytes of the phrase; without texts there are no rows; other columns are not
read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from versemill.llm.blocks import squeeze, unsqueeze
from versemill.llm.common import encoded
from versemill.session import cut_lineage

#: Occurrences of a phrase that is reported.
LEAST = 10
#: Share of the texts in the sample, and its lowered limit.
SAMPLE, SAMPLE_LEAST = 0.125, 2
#: Words a block; a longer text is a block of its own.
BLOCK_WORDS = 350_000
#: Texts, and blocks, that come to a task at once. Left to Spark, all blocks of a task would come in
#: one Arrow batch, held in the executor and in its Python worker.
TEXTS_AT_ONCE, BLOCKS_AT_ONCE = 1000, 1
#: Bits of a map of proposed words or pairs: by the words that the sample proposes, between these
#: powers of 2 (8 KB and 16 MB), whatever the size of the data.
LEAST_BITS, MOST_BITS = 16, 27
#: Parts that a group is ranked in before its best rows come together.
PARTS = 64
ENDS = b".,;:!?\n\v\f\r"
TO_LINE = bytes.maketrans(ENDS, b"\n" * len(ENDS))
#: Stands for the end of a piece; no byte of a text.
END = b"\xff"
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@contextmanager
def at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """So many rows an Arrow batch in the jobs that run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def numbered_blocks(batches: Iterator[pa.RecordBatch], share: float, most: int) -> Iterator[pa.RecordBatch]:
    """(lang, text) → blocks of one group, in the sample or not."""
    rng = np.random.default_rng(TaskContext.get().partitionId())
    open_: dict[tuple[str, bool], tuple[defaultdict, list[np.ndarray], list[int]]] = {}

    def row(key, numbers, codes, size) -> pa.RecordBatch:
        words = list(numbers)[1:]
        return pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([key[0]], pa.string()),
                "drawn": pa.array([key[1]], pa.bool_()),
                "n": pa.array([size], pa.int64()),
                "words": pa.array([words], pa.list_(pa.binary())),
                "hashes": pa.array([np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64).tobytes()], pa.binary()),
                "codes": pa.array([squeeze(np.concatenate(codes))], pa.binary()),
            }
        )

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), encoded(batch.column("text"))):
            key = (lang, bool(rng.random() < share))
            if key not in open_:
                numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
                numbers[END]
                open_[key] = numbers, [], [0]
            numbers, codes, size = open_[key]
            words = text.lower().translate(TO_LINE).replace(b"\n", b" " + END + b" ").split()
            words.append(END)
            code = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            codes.append(code)
            size[0] += int(np.count_nonzero(code))
            if size[0] >= most:
                yield row(key, numbers, codes, size[0])
                del open_[key]
    for key in list(open_):
        numbers, codes, size = open_.pop(key)
        yield row(key, numbers, codes, size[0])


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Blocks as rows, one in memory at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def in_slices(batches: Iterator[pa.RecordBatch], most: int = 50_000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = a * ODD[0] ^ (a >> np.uint64(31))
    mixed = (mixed + b) * ODD[1]
    return mixed ^ (mixed >> np.uint64(29))


def hits(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes >> np.uint64(65 - len(bits).bit_length() - 3)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


#: Bit maps of the proposed words and of the proposed pairs.
Proposed = tuple[np.ndarray, np.ndarray]


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def counted_phrases(batches: Iterator[pa.RecordBatch], now: Proposed, before: list[Proposed], triples: bool) -> Iterator[pa.RecordBatch]:
    """Counts of the pairs and triples of each block that `now` admits and nothing before did."""
    for row in one_by_one(batches):
        codes = unsqueeze(row["codes"])
        hashes = np.append(np.uint64(0), np.frombuffer(row["hashes"], np.uint64))
        yield from phrases_of(row["lang"], codes, hashes, now, before, triples)


def phrase_rows(lang: str, a: np.ndarray, b: np.ndarray, c: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    third = pa.nulls(len(n), pa.int64()) if c is None else signed(c)
    parts = [pa.repeat(pa.scalar(lang, pa.string()), len(n)), signed(a), signed(b), third, pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(parts, names=["lang", "a", "b", "c", "n"])


def phrases_of(
    lang: str, codes: np.ndarray, hashes: np.ndarray, now: Proposed, before: list[Proposed], triples: bool
) -> list[pa.RecordBatch]:
    """The counts of one block. They are returned at once, so that the arrays they come from are gone
    when Spark takes them."""
    out = []
    size = len(hashes)
    word_of = [np.append(False, hits(p[0], hashes[1:])) for p in (now, *before)]
    # One place less than pairs at the end; a piece's end is never proposed.
    at = np.nonzero(word_of[0][codes[:-1]] & word_of[0][codes[1:]])[0]
    keys, place, n = np.unique(codes[at] * size + codes[at + 1], return_inverse=True, return_counts=True)
    x, y = keys // size, keys % size
    left, right = hashes[x], hashes[y]
    known = np.zeros(len(keys), bool)
    pair_of = []
    mixed = pair_hash(left, right)
    for words, p in zip(word_of, (now, *before)):
        both = words[x] & words[y]
        pair_of.append(both & hits(p[1], mixed))
        if p is not now:
            known |= both
    new = ~known
    if new.any():
        out.append(phrase_rows(lang, left[new], right[new], None, n[new]))
    if not triples or len(at) < 2:
        return out
    held = pair_of[0][place]
    start = np.nonzero((at[1:] == at[:-1] + 1) & held[1:] & held[:-1])[0]
    triple = place[start] * size + y[place[start + 1]]
    pairs_here = keys
    del place, at, held, start, known, mixed
    keys, n = np.unique(triple, return_counts=True)
    one, z = keys // size, keys % size
    two = np.searchsorted(pairs_here, y[one] * size + z)
    new = np.ones(len(keys), bool)
    for pairs in pair_of[1:]:
        new &= ~(pairs[one] & pairs[two])
    if new.any():
        one, z, n = one[new], z[new], n[new]
        out.append(phrase_rows(lang, left[one], right[one], hashes[z], n))
    return out


def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in one_by_one(batches):
        words = row["words"]
        n = np.bincount(unsqueeze(row["codes"]), minlength=len(words) + 1)[1:]
        hashes = np.frombuffer(row["hashes"], np.uint64)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([row["lang"]] * len(words), pa.string()),
                "a": signed(hashes),
                "word": pa.array(words, pa.binary()).cast(pa.string()),
                "n": pa.array(n, pa.int64()),
            }
        )


def word_counts(blocks: DataFrame, least: int) -> DataFrame:
    """(lang, a, word, n) of the words that occur `least` times (written)."""
    counts = blocks.mapInArrow(lambda batches: in_slices(counted_words(batches)), "lang string, a long, word string, n long")
    with at_once(blocks.sparkSession, BLOCKS_AT_ONCE):
        return cut_lineage(counts.groupBy("lang", "a", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


def phrase_counts(blocks: DataFrame, now: Broadcast, before: list[Broadcast], least: int, triples: bool = True) -> DataFrame:
    """(lang, a, b, c, n) of the phrases counted in this pass that occur `least` times (written)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_slices(counted_phrases(batches, now.value, [b.value for b in before], triples))

    counts = blocks.select("lang", "hashes", "codes").mapInArrow(run, "lang string, a long, b long, c long, n long")
    with at_once(blocks.sparkSession, BLOCKS_AT_ONCE):
        return cut_lineage(counts.groupBy("lang", "a", "b", "c").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


def bit_map(rows: DataFrame, columns: list[str], power: int) -> np.ndarray:
    """A map of 2 ** `power` bits with that of every word (column a) or pair (a, b), on the driver."""
    page_power = power - 6

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.asarray(batch.column(c)).view(np.uint64) for c in columns]
            slot = np.unique(reduce(pair_hash, parts) >> np.uint64(64 - power)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"page": pa.array(slot >> page_power), "slot": pa.array(slot & ((1 << page_power) - 1))})

    def page(key, pdf):
        import pandas as pd

        bits = np.zeros(1 << page_power, np.uint8)
        bits[pdf["slot"].to_numpy()] = 1
        return pd.DataFrame({"page": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    found = rows.select(*columns).mapInArrow(slots, "page long, slot long")
    out = np.zeros(1 << (power - 3), np.uint8)
    width = 1 << (page_power - 3)
    for r in found.groupBy("page").applyInPandas(page, "page long, bits binary").collect():
        out[r["page"] * width : (r["page"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return out


def missing(bits: np.ndarray, new: np.ndarray) -> bool:
    return bool((new & ~bits).any())


def frequent(docs: DataFrame, lang: str, text: str, least: int, share: float, sample_least: int, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blocks, words, phrases): all words and phrases of up to three words that occur `least` times in a group."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    fields = "lang string, drawn boolean, n long, words array<binary>, hashes binary, codes binary"
    with at_once(docs.sparkSession, TEXTS_AT_ONCE):
        blocks = cut_lineage(rows.mapInArrow(lambda batches: numbered_blocks(batches, share, most), fields))

    drawn = blocks.filter("drawn")
    drawn_words = word_counts(drawn, sample_least)
    power = min(MOST_BITS, max(LEAST_BITS, (64 * drawn_words.count()).bit_length()))
    words = bit_map(drawn_words, ["a"], power)
    proposal = context.broadcast((words, np.zeros_like(words)))
    pairs = bit_map(phrase_counts(drawn, proposal, [], sample_least, triples=False), ["a", "b"], power)
    proposal.unpersist()
    all_words = word_counts(blocks, least)
    frequent_words = bit_map(all_words, ["a"], power)
    passes, found = [], None
    while True:
        proposal = context.broadcast((words, pairs))
        counted = phrase_counts(blocks, proposal, passes, least)
        found = counted if found is None else found.unionByName(counted)
        passes.append(proposal)
        frequent_pairs = bit_map(found.filter("c IS NULL"), ["a", "b"], power)
        if not missing(words, frequent_words) and not missing(pairs, frequent_pairs):
            return blocks, all_words, found
        words, pairs = words | frequent_words, pairs | frequent_pairs


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in whole decimals."""
    whole = lambda c: c.cast("decimal(18,0)")
    product, below = F.lit(1_000_000).cast("decimal(7,0)") * (whole(a) * whole(a)), whole(left) * whole(right)
    return F.floor((product - product % below) / below).cast("long")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", top: int = 2000, least: int = LEAST, cover: int = 50,
    share: float = SAMPLE, sample_least: int = SAMPLE_LEAST, most: int = BLOCK_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each group.

    a, l and r count the phrase and the parts of its lowest-scoring cut, n all words. A phrase is left
    out if a longer one that contains it has `cover` percent of its occurrences.
    """
    blocks, words, phrases = frequent(docs, lang, text, least, share, sample_least, most)
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("total"))

    def word(key: str, n: str, shown: str) -> DataFrame:
        return words.select("lang", F.col("a").alias(key), F.col("n").alias(n), F.col("word").alias(shown))

    pairs = phrases.filter("c IS NULL").select("lang", "a", "b", "n")
    triples = phrases.filter("c IS NOT NULL")
    inside = triples.select("lang", "a", "b", "n").unionByName(triples.select("lang", F.col("b").alias("a"), F.col("c").alias("b"), "n"))
    longest = inside.groupBy("lang", "a", "b").agg(F.max("n").alias("longer"))
    kept = pairs.join(longest, ["lang", "a", "b"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("n")))
    two = kept.join(word("a", "l", "x"), ["lang", "a"]).join(word("b", "r", "y"), ["lang", "b"])
    two = two.select("lang", F.concat_ws(" ", "x", "y").alias("phrase"), "n", "l", "r", cut_score(F.col("n"), F.col("l"), F.col("r")).alias("score"))

    three = (
        triples.join(pairs.withColumnRenamed("n", "l2"), ["lang", "a", "b"])
        .join(pairs.select("lang", F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("r1")), ["lang", "b", "c"])
        .join(word("a", "l1", "x"), ["lang", "a"])
        .join(word("b", "m", "y"), ["lang", "b"])
        .join(word("c", "r2", "z"), ["lang", "c"])
    )
    cuts = [F.struct(cut_score(F.col("n"), F.col(l_), F.col(r)).alias("score"), F.lit(k).alias("k"), F.col(l_).alias("l"), F.col(r).alias("r")) for k, l_, r in ((1, "l1", "r1"), (2, "l2", "r2"))]
    three = three.select("lang", F.concat_ws(" ", "x", "y", "z").alias("phrase"), "n", F.least(*cuts).alias("cut"))
    three = three.select("lang", "phrase", "n", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("n"), F.asc("phrase")]
    rows = two.unionByName(three).withColumn("part", F.pmod(F.hash("phrase"), F.lit(PARTS)))
    best = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("n").alias("a"), "l", "r", F.col("total").alias("n"), "score"
    )
