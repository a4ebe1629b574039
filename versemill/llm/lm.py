"""Texts scored by a word model with deleted interpolation.

The model mixes maximum-likelihood estimates of bigrams, of words, and a uniform one over the
vocabulary and one unknown word. The mixture weights depend on how often the context was seen (a
bucket for each doubling) and are learned by expectation-maximisation on deleted counts: each
training token is held out in turn, by taking it off the counts that estimate it.

Counts come from the whole corpus through `blocks.counted`; they are answered to the blocks that
hold the words, so no count is broadcast. The tokens' deleted estimates are summed in cells (the
bucket of the context, the two estimates to a quarter of an octave) whose number is bounded by
construction; the weights are learned from the cells.

Defined cases: an absent or empty text is its end token; repeated rows count and are scored as
often as they occur; without training rows every token gets the uniform share of one unknown
word; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.llm.blocks import END_HASH, answers_of, bucket_bits, counted, requests, token_blocks, unpack_sorted, unsqueeze

WORDS, BIGRAMS = 0, 1
#: Cells of the deleted estimates: steps an octave, and octaves below 1.
STEPS, OCTAVES = 4, 60
BUCKETS = 64
ROUNDS, TOLERANCE, LEAST = 200, 1e-7, 1e-6


def tokens_of(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, place of each token, place of the token before, whether it is learned from).

    The end of a document is the context of the next one's first word.
    """
    words, codes = unpack_sorted(row["words"]), unsqueeze(row["codes"])
    end = np.searchsorted(words, END_HASH)
    before = np.concatenate([[end], codes[:-1]])
    learned = np.repeat(np.asarray(row["flags"], bool), np.asarray(row["lengths"], np.int64))
    return words, codes, before, learned


def bigram_keys(words: np.ndarray, codes: np.ndarray, before: np.ndarray) -> np.ndarray:
    key = words[before] * np.uint64(0xD6E8FEB86659FD93)
    key ^= key >> np.uint64(32)
    key += words[codes]
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(29))


def keys_of(row: dict) -> list[tuple[int, np.ndarray, np.ndarray]]:
    words, codes, before, learned = tokens_of(row)
    n_words = np.bincount(codes[learned], minlength=len(words))
    keys, place = np.unique(bigram_keys(words, codes, before), return_inverse=True)
    return [(WORDS, words, n_words), (BIGRAMS, keys, np.bincount(place[learned], minlength=len(keys)))]


def counts_of(row, answers) -> tuple[np.ndarray, ...]:
    """For each token the counts of bigram, context and word, and whether it is learned from."""
    words, codes, before, learned = tokens_of(row)
    place = np.unique(bigram_keys(words, codes, before), return_inverse=True)[1]
    sums = answers_of(answers)
    return sums[BIGRAMS][place], sums[WORDS][before], sums[WORDS][codes], learned


def context_bucket(n: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + floor(log2 n)."""
    return np.frexp(n.astype(np.float64))[1]


def share(part: np.ndarray, whole: np.ndarray | float) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(part)), where=np.asarray(whole) > 0)


def level(p: np.ndarray) -> np.ndarray:
    """A cell of p: 0 for 0, else by quarters of octaves from 1 down."""
    logs = np.log2(np.maximum(p, 2.0**-OCTAVES))
    return np.where(p > 0, 1 + np.minimum(np.rint(-logs * STEPS), STEPS * OCTAVES - 1), 0).astype(np.int64)


def deleted_cells(total: int):
    """Blocks and their answers → cells of deleted estimates: tokens and sums of both."""

    def run(key, block, answers):
        import pandas as pd

        if block.empty or answers.empty:
            return pd.DataFrame({"cell": [], "n": [], "two": [], "one": []})
        pair, context, word, learned = (x for x in counts_of(block.iloc[0], answers))
        pair, context, word = (x[learned] - 1 for x in (pair, context, word))
        two, one = share(pair, context), word / max(1, total - 1)
        cell = (context_bucket(context) * (STEPS * OCTAVES + 1) + level(two)) * (STEPS * OCTAVES + 1) + level(one)
        cells, place = np.unique(cell, return_inverse=True)
        return pd.DataFrame(
            {
                "cell": cells,
                "n": np.bincount(place, minlength=len(cells)),
                "two": np.bincount(place, two, len(cells)),
                "one": np.bincount(place, one, len(cells)),
            }
        )

    return run


def learn_weights(bucket: np.ndarray, n: np.ndarray, two: np.ndarray, one: np.ndarray, none: float) -> np.ndarray:
    """Weights [bucket, (bigram, word, uniform)] that make the held-out tokens likeliest.

    A bucket without tokens takes the weights of the next one below it.
    """
    estimates = np.stack([two, one, np.full(len(n), none)], 1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    for _ in range(ROUNDS):
        parts = weights[bucket] * estimates
        parts *= (n / parts.sum(1))[:, None]
        sums = np.stack([np.bincount(bucket, parts[:, k], BUCKETS) for k in range(3)], 1)
        seen = sums.sum(1) > 0
        new = weights.copy()
        new[seen] = sums[seen] / sums[seen].sum(1, keepdims=True)
        new = np.maximum(new, LEAST)
        new[0, 0] = 0
        new /= new.sum(1, keepdims=True)
        moved = np.abs(new - weights)[seen].max(initial=0)
        weights = new
        if moved < TOLERANCE:
            break
    held = np.bincount(bucket, n, BUCKETS) > 0
    for b in range(2, BUCKETS):
        if not held[b] and held[1 : b].any():
            weights[b] = weights[b - 1]
    return weights


def score_blocks(total: int, vocabulary: int, weights: np.ndarray, id_kind: str):
    def run(key, block, answers):
        import pandas as pd

        row = block.iloc[0]
        pair, context, word, _ = counts_of(row, answers)
        w = weights[context_bucket(context)]
        p = w[:, 0] * share(pair, context) + w[:, 1] * word / max(1, total) + w[:, 2] / (vocabulary + 1)
        lengths = np.asarray(row["lengths"], np.int64)
        at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        base = np.log10((word + 1) / (total + vocabulary + 1))
        ids = pd.Series(list(row["ids"]), dtype="Int64" if id_kind in ("bigint", "int") else object)
        return pd.DataFrame(
            {
                "id": ids,
                "learned": list(row["flags"]),
                "n_tokens": lengths,
                "n_known": np.add.reduceat((word > 0).astype(np.int64), at),
                "base_score": np.add.reduceat(base, at),
                "score": np.add.reduceat(np.log10(p), at),
            }
        )

    return run


def interpolated_scores(docs: DataFrame) -> DataFrame:
    """(id, flag, text) → id, learned, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows with a true flag and scores every row.
    """
    id_kind = dict(docs.dtypes)["id"]
    blocks = token_blocks(docs, ends=True)
    learned = F.aggregate(F.arrays_zip("flags", "lengths"), F.lit(0).cast("long"), lambda s, x: s + F.when(x["flags"], x["lengths"]).otherwise(0))
    tokens = F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)
    sums = blocks.agg(F.sum(learned).alias("learned"), F.sum(tokens).alias("all")).head()
    total = sums["learned"] or 0
    answers = counted(requests(blocks, keys_of, bucket_bits(sums["all"] or 0)))
    vocabulary = answers.filter(F.col("kind") == WORDS).agg(F.sum("present")).head()[0] or 0
    both = blocks.groupBy("block").cogroup(answers.drop("present").groupBy("block"))
    cells = both.applyInPandas(deleted_cells(total), "cell long, n long, two double, one double")
    held = cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("two").alias("two"), F.sum("one").alias("one")).orderBy("cell").toPandas()
    n = held["n"].to_numpy(np.float64)
    weights = learn_weights(
        (held["cell"] // (STEPS * OCTAVES + 1) ** 2).to_numpy(np.int64),
        n,
        (held["two"] / n).to_numpy(),
        (held["one"] / n).to_numpy(),
        1 / (vocabulary + 1),
    )
    scored = both.applyInPandas(
        score_blocks(total, vocabulary, weights, id_kind),
        f"id {id_kind}, learned boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))
