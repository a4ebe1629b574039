"""Terms of documents: n-grams, counts, vocabularies, TF-IDF.

Counting inside a document happens in its task, on Arrow batches of whole documents, so the large
(document, term) table needs no shuffle. Vocabularies are limited to `max_features` terms,
which bounds what is broadcast.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versemill.functions import text
from versemill.session import cut_lineage

MAX_FEATURES = 5000
#: Sums by digest that tell which terms can be frequent, and how many of them are moved as a row.
SUMS, SUMS_AT_ONCE = 1 << 20, 1 << 14
#: Words that a task counts at once (a longer document by itself), and rows that it puts out at once.
WORDS_AT_ONCE, ROWS_AT_ONCE = 1_000_000, 200_000


def preprocess(raw: Column, language: str = "english", drop_stopwords: bool = True) -> Column:
    """Content words of a text: clean, tokenize, stop words, no short words."""
    return text.content_words(text.clean_text(raw), language if drop_stopwords else None)


def drop_empty(df: DataFrame, id_col: str, made: Column, name: str) -> DataFrame:
    """Rows whose derived text is not empty.

    A plain filter would move below the projection and make the text a second time; a
    generated column is made once and filtered where it stands.
    """
    rows = df.select(id_col, F.explode_outer(F.array(made)).alias(name))
    return rows.filter(F.length(name) > 0)


def _grams(lists: pa.Array, longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Different n-grams of some lists of words; for each occurrence its list and its n-gram; and how
    many each list has. A word that is null counts as one, but is in no n-gram."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.cast(lists.flatten(), pa.large_string()).dictionary_encode()
    word = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(lists)), lengths)
    texts, known = [coded.dictionary], len(coded.dictionary)
    docs, grams = [doc[word >= 0]], [word[word >= 0]]
    size, at, gram, names = lengths.copy(), np.arange(len(word)), word, coded.dictionary
    for n in range(2, longest + 1):
        # The n-gram that starts at a word, from the shorter one there and the word behind it.
        goes = at + n - 1 < len(word)
        at, gram = at[goes], gram[goes]
        last = word[at + n - 1]
        goes = (gram >= 0) & (last >= 0) & (doc[at] == doc[at + n - 1])
        at, gram, last = at[goes], gram[goes], last[goes]
        pairs, gram = np.unique(gram * max(1, len(coded.dictionary)) + last, return_inverse=True)
        first, behind = np.divmod(pairs, max(1, len(coded.dictionary)))
        names = pc.binary_join_element_wise(names.take(pa.array(first)), coded.dictionary.take(pa.array(behind)), pa.scalar(" ", pa.large_string()))
        docs.append(doc[at])
        grams.append(gram + known)
        texts.append(names)
        known += len(names)
        size += np.bincount(doc[at], minlength=len(lists))
    # Words that hold blanks can make equal n-grams of different lengths.
    every = pa.concat_arrays(texts).dictionary_encode()
    return every.dictionary, np.concatenate(docs), every.indices.to_numpy().astype(np.int64)[np.concatenate(grams)], size


def _counted(batch: pa.RecordBatch, longest: int) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, n-grams, row, n-gram, count, n-grams of each row) of some rows at a time."""
    words = batch.column("_words")
    ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(words):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + WORDS_AT_ONCE, "right")))
        names, doc, gram, size = _grams(words.slice(start, stop - start), longest)
        pairs, n = np.unique(doc * max(1, len(names)) + gram, return_counts=True)
        row, gram = np.divmod(pairs, max(1, len(names)))
        yield start, names, row, gram, n, size
        start = stop


def term_counts(df: DataFrame, id_col: str, tokens: Column, longest: int = 1) -> DataFrame:
    """(id, term, tf, length): counts of the n-grams of each document, without a shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(id_col)
            for start, names, row, gram, n, size in _counted(batch, longest):
                for a in range(0, len(row), ROWS_AT_ONCE):
                    part = slice(a, a + ROWS_AT_ONCE)
                    columns = [ids.take(pa.array(start + row[part])), names.take(pa.array(gram[part])).cast(pa.string()), n[part], size[row[part]]]
                    yield pa.RecordBatch.from_arrays([*columns[:2], *map(pa.array, columns[2:])], names=[id_col, "term", "tf", "length"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, tokens.alias("_words")).mapInArrow(count, f"`{id_col}` {kind}, term string, tf long, length long")


def word_doc_frequency(counts: DataFrame) -> DataFrame:
    """(term, df, total): documents with the term, and its occurrences."""
    return counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))


def term_frequencies(df: DataFrame, tokens: Column, longest: int = 1) -> DataFrame:
    """The same from the documents. Tasks add up terms over many documents before anything is a row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, names, _, gram, n, _ in _counted(batch, longest):
                df_, total = np.bincount(gram, minlength=len(names)), np.bincount(gram, n, len(names)).astype(np.int64)
                for a in range(0, len(names), ROWS_AT_ONCE):
                    part = slice(a, a + ROWS_AT_ONCE)
                    columns = [names[part].cast(pa.string()), pa.array(df_[part], pa.int64()), pa.array(total[part])]
                    yield pa.RecordBatch.from_arrays(columns, names=["term", "df", "total"])

    own = df.select(tokens.alias("_words")).mapInArrow(count, "term string, df long, total long")
    return own.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def vocabulary(
    frequencies: DataFrame,
    n_docs: int,
    by: str = "total",
    min_df: int = 3,
    max_df: float = 0.92,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """The terms kept: df within limits, then the most frequent by `df` or `total`.

    Ties go to the first term in order. At most `max_features` rows.
    """
    within = frequencies.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))
    return within.orderBy(F.desc(by), "term").limit(max_features)


def _places(names: pa.Array) -> np.ndarray:
    """The sum that each term belongs to."""
    return np.fromiter(map(zlib.crc32, names.cast(pa.large_binary()).to_pylist()), np.int64, len(names)) % SUMS


def _own_columns(k: int) -> list[str]:
    return [f"{what}{i}" for what in ("df", "total") for i in range(k + 1)]


def _fold_frequencies(df: DataFrame, tokens: Column, fold: str, k: int, longest: int, can: np.ndarray | None = None) -> DataFrame:
    """(term, df0 … dfk, total0 … totalk): frequencies in each fold, and at k in rows of other folds; only
    of terms whose sum is marked in `can`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds = batch.column("_fold").to_numpy()
            for start, names, row, gram, n, _ in _counted(batch, longest):
                some = np.arange(len(names)) if can is None else np.flatnonzero(can[_places(names)])
                number = np.full(len(names), -1)
                number[some] = np.arange(len(some))
                held = number[gram] >= 0
                cell = number[gram[held]] * (k + 1) + folds[start + row[held]]
                cells = len(some) * (k + 1)
                sums = [x.astype(np.int64).reshape(-1, k + 1) for x in (np.bincount(cell, None, cells), np.bincount(cell, n[held], cells))]
                names = names.take(pa.array(some))
                for a in range(0, len(some), ROWS_AT_ONCE):
                    part = slice(a, a + ROWS_AT_ONCE)
                    columns = [names[part].cast(pa.string()), *[pa.array(np.ascontiguousarray(x[part, i])) for x in sums for i in range(k + 1)]]
                    yield pa.RecordBatch.from_arrays(columns, names=["term", *own])

    own = _own_columns(k)
    rows = df.select(tokens.alias("_words"), F.col(fold).alias("_fold"))
    return rows.mapInArrow(count, "term string, " + ", ".join(f"{c} long" for c in own)).groupBy("term").agg(*[F.sum(c).alias(c) for c in own])


def _term_sums(df: DataFrame, tokens: Column, longest: int) -> np.ndarray:
    """Occurrences of all terms by SUMS digests, which are added up in the task and then over the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(SUMS, np.int64)
        for batch in batches:
            for _, names, _, gram, n, _ in _counted(batch, longest):
                sums += np.bincount(_places(names)[gram], n, SUMS).astype(np.int64)
        parts = sums.reshape(-1, SUMS_AT_ONCE)
        held = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array([parts[i].tobytes() for i in held], pa.binary())], names=["part", "sums"])

    def add(held: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, np.int64) for x in held.column("sums").to_pylist()], axis=0)
        return pa.table({"part": held.column("part")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, sums binary"
    found = df.select(tokens.alias("_words")).mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema)
    out = np.zeros((SUMS // SUMS_AT_ONCE, SUMS_AT_ONCE), np.int64)
    for r in found.collect():
        out[r["part"]] = np.frombuffer(r["sums"], np.int64)
    return out.ravel()


def fold_vocabularies(
    df: DataFrame, tokens: Column, fold: str, k: int, sizes: list[int], longest: int = 2,
    min_df: int = 3, max_df: float = 0.92, max_features: int = MAX_FEATURES,
) -> list[DataFrame]:
    """For each fold 0 … k-1 the vocabulary of the rows outside of it (`sizes` of them): that of
    `vocabulary(term_frequencies(...))`, from three passes for all folds.

    The words that are kept most often bound what a term must have at least to be kept. Terms are
    added up by digest first, and only those are counted each by itself whose sum comes to that, so
    that the many n-grams that occur a few times are not moved.
    """
    rows = df.select(tokens.alias("_words"), F.when(F.col(fold).between(0, k - 1), F.col(fold)).otherwise(F.lit(k)).cast("int").alias("_fold"), fold)
    rows = rows.filter(F.col(fold).isNotNull())

    def outside(frequencies: DataFrame, i: int) -> DataFrame:
        less = [sum((F.col(f"{what}{j}") for j in range(k + 1) if j != i), F.lit(0).cast("long")).alias(what) for what in ("df", "total")]
        return frequencies.select("term", *less)

    def kept(frequencies: DataFrame) -> DataFrame:
        within = F.lit(False)
        for i in range(k):
            within |= sum((F.col(f"df{j}") for j in range(k + 1) if j != i), F.lit(0).cast("long")) >= min_df
        return cut_lineage(frequencies.filter(within))

    limits = dict(min_df=min_df, max_df=max_df, max_features=max_features)
    # A word with a blank can be an n-gram as well, and then has more than is counted here.
    words = kept(_fold_frequencies(rows, F.col("_words"), "_fold", k, 1).filter(~F.contains("term", F.lit(" "))))
    least = []
    for i, n in enumerate(sizes):
        held = vocabulary(outside(words, i), n, **limits).agg(F.count("*").alias("held"), F.min("total").alias("least")).head()
        least.append(held["least"] if held["held"] == max_features else min_df)
    can = _term_sums(rows, F.col("_words"), longest) >= max(min_df, min(least, default=0))
    counted = kept(_fold_frequencies(rows, F.col("_words"), "_fold", k, longest, can))
    return [vocabulary(outside(counted, i), n, **limits) for i, n in enumerate(sizes)]


def in_vocabulary(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Counts of known terms; the vocabulary is limited, hence small enough to broadcast."""
    return counts.join(F.broadcast(vocab.select("term", "df")), "term")


def tfidf_relative(counts: DataFrame, vocab: DataFrame, n_docs: int, id_col: str) -> DataFrame:
    """tf / length · ln(N / (df + 1))."""
    weight = F.col("tf") / F.col("length") * F.log(F.lit(n_docs) / (F.col("df") + 1))
    return in_vocabulary(counts, vocab).select(id_col, "term", weight.alias("weight"))


def smooth_idf(n_docs: int) -> Column:
    return F.log((1 + F.lit(n_docs)) / (1 + F.col("df"))) + 1


def tfidf_smooth_l2(counts: DataFrame, vocab: DataFrame, n_docs: int, id_col: str) -> DataFrame:
    """tf · (ln((1 + N) / (1 + df)) + 1), rows scaled to length 1.

    The known terms of a document meet once (at most `max_features` of them).
    """
    raw = in_vocabulary(counts, vocab).select(id_col, "term", (F.col("tf") * smooth_idf(n_docs)).alias("w"))
    rows = raw.groupBy(id_col).agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
        F.collect_list(F.struct("term", "w")).alias("terms"),
    )
    return rows.select(id_col, "norm", F.explode_outer("terms").alias("t")).select(
        id_col, "t.term", (F.col("t.w") / F.col("norm")).alias("weight")
    )


def fitted_terms(vocab: DataFrame, n_docs: int) -> list[tuple[str, float]]:
    """(term, idf) of the vocabulary in term order; it is limited, so the driver can hold it."""
    rows = vocab.select("term", smooth_idf(n_docs).alias("idf")).orderBy("term").collect()
    return [(r["term"], r["idf"]) for r in rows]


def tfidf_vectors(
    df: DataFrame, tokens: Column, fitted: list[tuple[str, float]], longest: int = 2, out: str = "tfidf"
) -> DataFrame:
    """The same weights as sparse vectors, row by row."""
    model = CountVectorizerModel.from_vocabulary(
        [term for term, _ in fitted], inputCol="_grams", outputCol="_tf"
    )
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense([idf for _, idf in fitted]), inputCol="_tf", outputCol="_raw"
    )
    scale = Normalizer(p=2.0, inputCol="_raw", outputCol=out)
    grams = df.withColumn("_words", tokens).withColumn("_grams", text.ngrams(F.col("_words"), longest))
    return scale.transform(weigh.transform(model.transform(grams))).drop("_words", "_grams", "_tf", "_raw")


def fallback_features(
    df: DataFrame, id_col: str, column: str, **limits
) -> tuple[str, DataFrame]:
    """TF-IDF of a short text column; without any term left, again with stop words; else one-hot.

    Returns the branch taken and (id, feature, value).
    """
    n_docs = df.count()
    for branch, drop in (("tfidf", True), ("tfidf_with_stopwords", False)):
        counts = term_counts(df, id_col, preprocess(F.col(column), drop_stopwords=drop), 2)
        vocab = vocabulary(word_doc_frequency(counts), n_docs, **limits)
        if not vocab.isEmpty():
            weights = tfidf_smooth_l2(counts, vocab, n_docs, id_col)
            return branch, weights.select(id_col, F.col("term").alias("feature"), F.col("weight").alias("value"))
    shown = df.filter(F.col(column).isNotNull())
    return "one_hot", shown.select(id_col, F.col(column).alias("feature"), F.lit(1.0).alias("value"))
