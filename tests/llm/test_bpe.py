"""Byte-pair encoding against a public library and a merge loop of its own, decoding, odd rows."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from helpers import docs, empty, odd_rows, with_clashes
from pyspark.sql import functions as F

from __spark_entry__ import queries
from versemill.llm import bpe


@pytest.fixture(scope="module")
def ranks():
    return bpe.Ranks.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("test", pat_str=ranks.pattern, mergeable_ranks=ranks.ranks, special_tokens={})


def by_definition(word, ranks):
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        joins = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not joins:
            return [ranks[p] for p in parts]
        _, i = min(joins)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


ODD_TEXTS = [
    "  two  spaces \n and\n\n lines \t tabs \x0b\x0c\x1c\x1f\x85   end ",
    "it's we're I'LL they'd ''s 'tis don't", " lead", "trail ", "\n", " " * 300, "a" * 700, "ab" * 300, "-=" * 200 + "é" * 100,
    "漢字かな交じり文 中文没有空格的句子 한국어 ไทย हिन्दी", "🙂🙃👩‍👩‍👧‍👦 ½ ² Ⅷ ٣ 12345678901234567890", "x​y á ﻿", "<|endoftext|>",
]


def random_text(rng):
    alphabet = "aaabcde  \n\t'.,;!?-12é漢🙂 \x1f" + "".join(chr(rng.randrange(32, 0x3000)) for _ in range(5))
    return "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))


@pytest.mark.parametrize("settings", [{}, {"common": 0}, {"at_once": 40, "sample": 50, "common": 20}])
def test_equals_the_library(spark, ranks, library, settings):
    rng = random.Random(3)
    texts = [*ODD_TEXTS, *(random_text(rng) for _ in range(300))]
    frame = docs(spark, list(enumerate(texts))).repartition(3)
    for row in bpe.encode(frame, ranks, **settings).collect():
        assert row.ids == library.encode_ordinary(row.text), repr(row.text)


def test_merge_order_of_a_table_with_late_unions(spark):
    """A longer union may rank before a shorter one, and equal unions go from the left."""
    base = {bytes([b]): b for b in range(256)}
    for seed in range(6):
        rng = random.Random(seed)
        words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(60)})
        rng.shuffle(words)
        own = bpe.Ranks({**base, **{w: 256 + i for i, w in enumerate(words)}}, r"\S+")
        texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 40))) for _ in range(60)]
        for row in bpe.encode(docs(spark, list(enumerate(texts))), own, common=0).collect():
            assert row.ids == by_definition(row.text.encode(), own.ranks)


def test_odd_rows_clashing_columns_and_decoding(spark, ranks, library):
    plain = docs(spark, odd_rows())
    clashing = with_clashes(plain, "ids", "word0", "codes0", "bytes", "_key")
    back = lambda d: bpe.encode(d, ranks).withColumn("back", bpe.decode(F.col("ids"), ranks))
    a, b = back(plain), back(clashing)
    assert b.columns == [*plain.columns, "word0", "codes0", "bytes", "_key", "ids", "back"]
    key = lambda r: (str(r.doc_id), str(r.text))
    rows, others = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert [(r.ids, r.back) for r in rows] == [(r.ids, r.back) for r in others] and len(rows) == len(odd_rows())
    assert all(r.ids == library.encode_ordinary(r.text or "") and r.back.decode() == (r.text or "") for r in rows)
    assert {r["word0"] for r in others} == {"clash"}
    assert bpe.encode(empty(spark), ranks).count() == 0


def test_query(spark, small, library):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for doc_id, text in rows:
        ids = library.encode_ordinary(text)
        want.add((doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(text.encode())))
    assert {tuple(r) for r in queries()["op13_byte_pairs"](spark, small).collect()} == want


def test_words_are_merged_together_in_the_task(spark, ranks):
    """Words of all lengths at once, and no step of Spark's between cutting and merging."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcdeést漢 ") for _ in range(rng.randrange(1, 30))).encode() for _ in range(500)} - set(ranks.ranks))
    ids, sizes = bpe.Merges(ranks).encode([*words, b"a" * 5000])
    bounds = [0, *sizes.cumsum().tolist()]
    assert [ids[x:y].tolist() for x, y in zip(bounds, bounds[1:])][:-1] == [by_definition(w, ranks.ranks) for w in words]
    assert b"".join({v: k for k, v in ranks.ranks.items()}[i] for i in ids[bounds[-2] :].tolist()) == b"a" * 5000
    plan = bpe.encode(docs(spark, odd_rows()), ranks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "lambda" not in plan
