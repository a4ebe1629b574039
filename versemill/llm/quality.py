"""Host-level quality rules.

Each document is counted on its own; the share of failing documents of each host is shrunk
towards the mean of all hosts by a beta prior fitted to the hosts; the verdict on the host goes
back to its documents.

Defined cases: an absent or empty text has no words and fails; an absent host is a host of its
own; repeated rows are counted and returned as often as they occur; no rows give no rows; other
columns are not read, so their names do not matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.llm.common import appended, encoded, pieces, schema_with
from versemill.session import cut_lineage

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A host is rejected when its shrunk share of failures is above this.
MAX_HOST_RATE = 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the counts of COUNTS and takes the text off."""
    blank, symbol = np.zeros(256, bool), np.zeros(256, bool)
    blank[list(b" \t\n\x0b\x0c\r")] = True
    symbol[list(SYMBOLS)] = True
    starts_character = (np.arange(256) & 0xC0) != 0x80
    rng = np.random.default_rng(7)
    factors = rng.integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)

    def repeats(lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Words of each text that lie in a window of WINDOW words found twice or more in the text."""
        n = len(lengths)
        owner = np.repeat(np.arange(n), lengths)
        if len(codes) < WINDOW:
            return np.zeros(n, np.int64)
        m = len(codes) - WINDOW + 1
        inside = owner[:m] == owner[WINDOW - 1 :]
        # The code of a word and its text are mixed before the windows are summed.
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        key = owner[:m].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        for i in range(WINDOW):
            key += mixed[i : i + m] * factors[i]
        at = np.flatnonzero(inside)
        if not len(at):
            return np.zeros(n, np.int64)
        _, back, seen = np.unique(key[at], return_inverse=True, return_counts=True)
        found = at[seen[back] > 1]
        edges = np.zeros(len(codes) + 1, np.int64)
        np.add.at(edges, found, 1)
        np.add.at(edges, found + WINDOW, -1)
        return np.bincount(owner[np.cumsum(edges[:-1]) > 0], minlength=n)

    def counted(texts: list[bytes]) -> list[np.ndarray]:
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        words = [text.split() for text in texts]
        lengths = np.array([len(w) for w in words], np.int64)
        codes = np.fromiter((numbers[w] for ws in words for w in ws), np.int64, int(lengths.sum()))
        ends = np.cumsum([0, *map(len, texts)])
        raw = np.frombuffer(b"".join(texts), np.uint8)

        def total(flags: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(flags[raw])])[ends])

        lines = [[line for line in text.split(b"\n") if line.strip()] for text in texts]
        again = np.array([len(x) - len(set(x)) for x in lines], np.int64)
        return [lengths, total(starts_character & ~blank), total(symbol), again, repeats(lengths, codes)]

    for batch in batches:
        texts = encoded(batch.column("text"))
        parts = [counted(texts[a:b]) for a, b in pieces(texts)]
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * len(COUNTS)
        rest = batch.drop_columns(["text"])
        yield appended(rest, **{name: pa.array(x, pa.int64()) for name, x in zip(COUNTS, columns)})


def document_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(id, host) and the counts of every whole text."""
    named = docs.select(F.col(id_col).alias("id"), F.col(host).alias("host"), F.col(text).cast("string").alias("text"))
    fields = ", ".join(f"{c} long" for c in COUNTS)
    return named.mapInArrow(count_batches, schema_with(named.drop("text"), fields))


def failed() -> Column:
    """The document's own verdict, in whole numbers."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_verdicts(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n, failures, rate, host_kept): failures by host under an empirical beta prior.

    The prior has the mean of all documents; its weight comes from the variance between hosts
    beyond that of drawing n documents (method of moments). Hosts that do not differ more than
    by chance get the mean of all.
    """
    hosts = judged.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("failures"))
    share = F.col("failures") / F.col("n")
    sums = hosts.agg(
        F.sum("n").alias("all"),
        F.sum("failures").alias("bad"),
        F.count("*").alias("hosts"),
        F.sum(F.col("n") * share * share).alias("squares"),
    )
    mean = F.col("bad") / F.col("all")
    seen = F.col("squares") / F.col("all") - mean * mean
    by_chance = mean * (1 - mean) * F.col("hosts") / F.col("all")
    between = seen - by_chance
    weight = F.when(between > 0, F.greatest(mean * (1 - mean) / between - 1, F.lit(0.0)))
    prior = sums.select(mean.alias("mean"), weight.alias("weight"))  # one row
    rate = F.when(F.col("weight").isNull(), F.col("mean")).otherwise(
        (F.col("failures") + F.col("weight") * F.col("mean")) / (F.col("n") + F.col("weight"))
    )
    joined = hosts.join(F.broadcast(prior), how="inner").withColumn("rate", rate)
    return joined.select("host", "n", "failures", "rate", (F.col("rate") <= max_rate).alias("host_kept"))


def apply_rules(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """(id, host), the counts, `base_failed`, the host's `rate`, and `kept`."""
    # Read twice, for the hosts and for the documents; the texts are not read again.
    judged = cut_lineage(document_counts(docs, id_col, text, host).withColumn("failed", failed()))
    verdicts = host_verdicts(judged, max_rate).select(F.col("host").alias("_host"), "rate", "host_kept")
    joined = judged.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
    kept = ~F.col("failed") & F.col("host_kept")
    return joined.withColumn("kept", kept).withColumnRenamed("failed", "base_failed").drop("host_kept")
