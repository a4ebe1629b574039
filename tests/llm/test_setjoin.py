import random

import numpy as np
import pytest
from helpers import docs, empty, odd_rows, text, union_find, with_clashes, words

from versemill.llm import blocks, setjoin
from versemill.llm.components import components


def shingles(t):
    ws = (t or "").encode().lower().split()
    if not ws:
        return frozenset()
    return frozenset([tuple(ws)] if len(ws) < 5 else [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)])


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    pairs = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a][1] and sets[b][1] and 100 * len(sets[a][1] & sets[b][1]) >= 80 * len(sets[a][1] | sets[b][1])
    ]
    root = union_find(pairs, range(len(sets)))
    first = {}
    for k, (i, _) in enumerate(sets):
        first.setdefault(root[k], []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in first.items()}
    return sorted(((i, len(s), least[root[k]] if s else i) for k, (i, s) in enumerate(sets)), key=repr)


def result(df):
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def near_rows(seed):
    """Chains of edits from short and long texts: links that hold and links that just fail."""
    rng = random.Random(seed)
    rows = []
    for base in range(12):
        ws = words(base + 100 * seed, rng.choice([3, 5, 8, 12, 14, 16, 18, 20, 40, 120]))
        for _ in range(rng.randrange(2, 9)):
            rows.append((len(rows), " ".join(ws)))
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(ws))
                ws = ws[:at] + ([f"x{rng.randrange(9)}"] if rng.random() < 0.6 else []) + ws[at + 1 :] or ["w1"]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_equal_brute_force(spark, seed):
    rows = near_rows(seed)
    assert result(setjoin.near_groups(docs(spark, rows))) == brute(rows)


def test_one_large_group_with_loose_ends(spark):
    """Copies with edits that are linked only through others, and a passage that all texts share."""
    rng = random.Random(5)
    base = words(9, 60)
    rows = []
    for i in range(150):
        ws = list(base)
        for _ in range(rng.randrange(0, 3)):
            ws[rng.randrange(len(ws))] = f"y{rng.randrange(30)}"
        rows.append((i, " ".join(ws)))
    rows += [(1000 + i, text(500 + i, 40) + " " + " ".join(base)) for i in range(20)]
    assert result(setjoin.near_groups(docs(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = odd_rows()
    df = with_clashes(docs(spark, rows), "id", "flag", "n", "mark", "block", "component")
    assert result(setjoin.near_groups(df)) == brute([r[:2] for r in rows])


def test_empty_table(spark):
    assert result(setjoin.near_groups(empty(spark))) == []


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(1000, 1100)] + [(3, 1000), (5, 5)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    nodes = {x for p in chain + hub for x in p if x != 5}
    assert found == union_find(chain + hub[:-1], nodes)


def test_least_overlap_and_prefix():
    for a in range(1, 60):
        for b in range(a, 80):
            o = setjoin.least_overlap(a, b)
            assert 100 * o >= 80 * (a + b - o) and 100 * (o - 1) < 80 * (a + b - o + 1)
        # Whatever set is linked has at least ceil(4a/5) of the elements.
        assert setjoin.prefix_length(a) == a - -(-4 * a // 5) + 1


def test_packing_round_trips():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 300_000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert np.array_equal(blocks.unpack_sorted(blocks.pack_sorted(keys)), keys)
        values = rng.integers(0, 2 ** int(rng.integers(1, 60)), n)
        assert np.array_equal(blocks.unsqueeze(blocks.squeeze(values)), values)


def test_what_draws_do_not_settle_is_compared_in_blocks(spark, monkeypatch):
    """Texts that share most words and still are not linked: all meet in one list, in groups of their own."""
    base = words(11, 33, 10**6)
    rows = [(k, " ".join([*base, *(f"u{k}x{j}" for j in range(7 if k % 10 else 3))])) for k in range(60)]
    counts, compared = [], setjoin.compared

    def recorded(pairs, sets):
        counts.append(pairs.count())
        return compared(pairs, sets)

    monkeypatch.setattr(setjoin, "compared", recorded)
    assert result(setjoin.near_groups(docs(spark, rows))) == brute(rows)
    assert counts and max(counts) <= len(rows)
