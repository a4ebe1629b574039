"""Byte-level byte-pair encoding of texts by a file of ranks, and decoding.

A text is cut into the matches of a pattern (its words), and each distinct word of a block of
texts is encoded once, many words at a time: their pieces lie in one array, with the rank of each
piece joined with its right neighbour beside it. One step finds the smallest rank of every word,
the leftmost of equal ones, merges there, and looks up the two ranks that change; words without a
rank are done. Ranks come from an array of token pairs in which a pair has two possible slots.

Texts and words never leave their task. Nothing is shuffled, and a lost executor costs its own
tasks. The commonest words of a bounded sample are encoded beforehand and sent along, which spares
work and changes no result.

The tokens are those that byte-pair merging defines: a word that is a token itself is that token;
else the pair of neighbours whose union has the smallest rank is merged, the leftmost first,
until no union is a token. Decoding puts the bytes of the tokens together.

Defined cases: an absent or empty text has no tokens and decodes to no bytes. Texts and words are
never cut short; a word of n bytes takes up to n steps over n numbers, so a single word of many
thousand bytes is slow. Repeated rows are encoded each by itself, extra columns come back as they
are, and a column named `ids` gives way to the result.
"""

from __future__ import annotations

import base64
import gc
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.llm.common import encoded, schema_with, without
from versemill.llm.runs import ranges

#: Bits of a token, and of a place in a word.
TOKEN, PLACE = 18, 26
#: The rank of two pieces whose union is no token.
NEVER = 1 << TOKEN
#: Factors of left and right token in the two slots of a pair.
SLOTS = ((40503, 1), (7919, 92821))
#: Words that are merged together.
TOGETHER = 20_000
#: Bytes of text a block; a longer text is a block of its own.
AT_ONCE = 16_000_000
#: Documents of the sample for common words, and how many of its words are encoded beforehand.
FIT_DOCUMENTS, COMMON_WORDS = 20_000, 200_000
#: Places at which every pattern of this kind starts a new word: a single space between two
#: characters that are no white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Marks that are a word of their own behind letters.
MARKS = frozenset(".,;:!?")


@dataclass(frozen=True)
class Ranks:
    """Tokens by their bytes, and the pattern of words. A rank is the number of its token."""

    ranks: dict[bytes, int]
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Ranks:
        """From lines of a token in base 64 and its rank."""
        with open(path, "rb") as lines:
            rows = (line.split() for line in lines)
            return cls({base64.b64decode(row[0]): int(row[1]) for row in rows if row}, pattern)

    @cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        """(left token, right token) → token of their union."""
        known = self.ranks
        return {
            (known[t[:i]], known[t[i:]]): rank
            for t, rank in known.items()
            for i in range(1, len(t))
            if t[:i] in known and t[i:] in known
        }

    @cached_property
    def table(self) -> list[int]:
        """Slots of the pairs: left, right and union in one number, or -1. A pair that is not in
        its first slot is in its second, and then its first is not empty."""
        size = 1 << max(4, (2 * len(self.pairs)).bit_length())
        slots = [-1] * size
        for (left, right), union in self.pairs.items():
            entry, turn = ((left << TOKEN | right) << TOKEN) | union, 0
            for _ in range(1000):
                key = entry >> TOKEN
                place = slot_of(key >> TOKEN, key & (NEVER - 1), turn, size)
                entry, slots[place] = slots[place], entry
                if entry < 0:
                    break
                key = entry >> TOKEN
                turn = int(slot_of(key >> TOKEN, key & (NEVER - 1), 0, size) == place)
            else:
                raise ValueError("no room for the pairs of tokens")
        return slots


def slot_of(left, right, turn: int, size: int):
    a, b = SLOTS[turn]
    return (left * a + right * b) & (size - 1)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unions(left: np.ndarray, right: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The tokens of pairs of tokens, or NEVER."""
    out = np.full(len(left), NEVER)
    for turn in range(len(SLOTS)):
        entry = table[slot_of(left, right, turn, len(table))]
        out = np.where(entry >> TOKEN == (left << TOKEN | right), entry & (NEVER - 1), out)
    return out


def merged(words: list[bytes], single: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of words that are no tokens themselves, one after the other, and how many each has."""
    number, sizes = np.arange(len(words)), np.array([len(w) for w in words], np.int64)
    tokens = single[np.frombuffer(b"".join(words), np.uint8)]
    rank = np.append(unions(tokens[:-1], tokens[1:], table), NEVER)
    rank[np.cumsum(sizes) - 1] = NEVER
    owners, parts = [], []
    while len(number):
        best = np.minimum.reduceat(rank << PLACE | np.arange(len(rank)), np.cumsum(sizes) - sizes)
        done = best >> PLACE == NEVER
        ended = np.repeat(done, sizes)
        owners.append(np.repeat(number[done], sizes[done]))
        parts.append(tokens[ended])
        at = (best & ((1 << PLACE) - 1))[~done]
        tokens[at] = rank[at]
        left = ~ended
        left[at + 1] = False
        at = np.cumsum(left)[at] - 1
        tokens, rank, number, sizes = tokens[left], rank[left], number[~done], sizes[~done] - 1
        last = np.cumsum(sizes) - 1
        rank[at[at == last]] = NEVER
        for changed in (at[at < last], at[at > last - sizes + 1] - 1):
            rank[changed] = unions(tokens[changed], tokens[changed + 1], table)
    owner = np.concatenate(owners) if owners else number
    order = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[order] if parts else tokens, np.bincount(owner, minlength=len(words))


class Merges:
    """What the tasks need of the ranks, as arrays."""

    def __init__(self, ranks: Ranks):
        self.single = np.array([ranks.ranks[bytes([b])] for b in range(256)], np.int64)
        self.table = np.array(ranks.table, np.int64)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        held = [merged(words[i : i + TOGETHER], self.single, self.table) for i in range(0, len(words), TOGETHER)]
        none = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        return tuple(np.concatenate(x) for x in zip(*(held or none)))


def decode(ids: Column, ranks: Ranks) -> Column:
    """The bytes of the tokens, one after the other; tokens that do not exist are skipped."""
    pieces_ = [""] * (max(ranks.ranks.values()) + 1)
    for piece, rank in ranks.ranks.items():
        pieces_[rank] = piece.hex()
    known = F.from_json(F.lit(json.dumps(pieces_)), "array<string>")
    return let(known, lambda p: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(p, i)), "")))


class Words:
    """Numbers of the words of a block. Tokens and common words have fixed ones."""

    def __init__(self, pattern: str, fixed: dict[bytes, int], n_fixed: int):
        self.find = regex.compile(pattern).findall
        self.fixed, self.n_fixed = fixed, n_fixed
        self.clear()

    def clear(self) -> None:
        self.new: dict[bytes, int] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}  # tuples of numbers are no work for the collector

    def number(self, word: str) -> int:
        key = word.encode()
        n = self.fixed.get(key)
        return self.new.setdefault(key, self.n_fixed + len(self.new)) if n is None else n

    def cut(self, chunk: str) -> list[int]:
        """The words of a text, or of what lies between two cuts. Letters are one word, with a
        space before them or not; so is a mark behind them."""
        end = len(chunk) - (chunk[-1:] in MARKS)
        if chunk[chunk[:1] == " " : end].isalpha():
            return [self.number(w) for w in (chunk[:end], chunk[end:]) if w]
        return [self.number(w) for w in self.find(chunk)]

    def numbers(self, text: str) -> np.ndarray:
        """Of all words of a text. Chunks between two cuts are looked up whole."""
        first, *others = text.split(" ")
        if not first or first[-1].isspace():
            first, *others = CUT.split(text)
        chunks, out = self.chunks, self.cut(first)
        for chunk in others:
            held = chunks.get(chunk)
            if held is None:
                if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                    break
                held = chunks[chunk] = tuple(self.cut(" " + chunk))
            out += held
        else:
            return np.array(out, np.int32)
        # More white space than single spaces.
        first, *others = CUT.split(text)
        return np.array([n for c in (first, *(" " + c for c in others)) for n in self.cut(c)], np.int32)


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    return [t.decode() for t in encoded(batch.column(text))]


def tokenized(
    batches: Iterator[pa.RecordBatch], text: str, words: Words, merges: Merges, fixed_ids: np.ndarray, fixed_sizes: np.ndarray, at_once: int
) -> Iterator[pa.RecordBatch]:
    """The rows with the tokens of their texts as `ids`, block by block."""
    held: list[tuple[pa.RecordBatch, list[np.ndarray]]] = []

    def block() -> Iterator[pa.RecordBatch]:
        ids, sizes = merges.encode(list(words.new))
        flat = np.concatenate([fixed_ids, ids])
        bounds = np.concatenate([[0], np.cumsum(np.concatenate([fixed_sizes, sizes]))])
        for batch, codes in held:
            code = np.concatenate(codes)
            n_ids = bounds[code + 1] - bounds[code]
            total = np.concatenate([[0], np.cumsum(n_ids)])[np.cumsum([0, *map(len, codes)])]
            own = pa.array(flat[ranges(bounds[code], n_ids)].astype(np.int32))
            out = pa.ListArray.from_arrays(pa.array(total.astype(np.int32)), own)
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, "ids"])
        held.clear()
        words.clear()

    size = 0
    for batch in batches:
        texts = texts_of(batch, text)
        start, codes = 0, []
        for i, t in enumerate(texts):
            if size and size + len(t) > at_once:
                if codes:
                    held.append((batch.slice(start, i - start), codes))
                yield from block()
                start, codes, size = i, [], 0
            codes.append(words.numbers(t))
            size += len(t)
        if codes:
            held.append((batch.slice(start, len(texts) - start), codes))
    if held:
        yield from block()


def common_words(docs: DataFrame, text: str, ranks: Ranks, sample: int, most: int) -> list[bytes]:
    """The commonest words of about `sample` rows that are no tokens themselves."""
    n = docs.count()
    drawn = docs.select(F.col(text).cast("string").alias("text"))
    if n > sample:
        share = int(2**32 * sample / n)
        drawn = drawn.filter(F.xxhash64("text", F.rand(7)).bitwiseAND((1 << 32) - 1) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.freeze()
        words = Words(ranks.pattern, ranks.ranks, NEVER)
        total = np.zeros(0, np.int64)
        for batch in batches:
            codes = np.concatenate([words.numbers(t) for t in texts_of(batch, "text")] or [np.zeros(0, np.int32)])
            n = np.bincount(codes[codes >= NEVER] - NEVER, minlength=len(words.new))
            n[: len(total)] += total
            total = n
        if len(total):
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(words.new), pa.binary()), "n": pa.array(total, pa.int64())})

    counts = drawn.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    best = counts.filter("n > 1").orderBy(F.desc("n"), "word").limit(most).select("word")
    found = best.collect()
    return [bytes(r["word"]) for r in found]


def encode(
    docs: DataFrame, ranks: Ranks, text: str = "text", sample: int = FIT_DOCUMENTS, common: int = COMMON_WORDS, at_once: int = AT_ONCE
) -> DataFrame:
    """The rows with `ids`, the tokens of their text."""
    context = docs.sparkSession.sparkContext
    rows = without(docs, "ids")
    known = common_words(docs, text, ranks, sample, common) if common else []
    n_tokens = max(ranks.ranks.values()) + 1
    merges = Merges(ranks)
    ids, sizes = merges.encode(known)
    ids = np.concatenate([np.arange(n_tokens), ids]).astype(np.int32)
    sizes = np.concatenate([np.ones(n_tokens, np.int64), sizes])
    sent = context.broadcast(({**ranks.ranks, **{w: n_tokens + i for i, w in enumerate(known)}}, merges, ids, sizes))
    pattern, n_fixed = ranks.pattern, n_tokens + len(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed, *arrays = sent.value
        gc.freeze()  # what was sent along is not looked through again
        yield from tokenized(batches, text, Words(pattern, fixed, n_fixed), *arrays, at_once)

    return rows.mapInArrow(run, schema_with(rows, "ids array<int>"))
