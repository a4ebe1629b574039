import hashlib

import pytest
from helpers import docs, empty, odd_rows, text, with_clashes

from versemill.llm import mixing


def brute_targets(sizes):
    """Excess above 3 times the size is shared again by weight until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        above = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not above or len(capped) + len(above) == len(names):
            return target
        capped |= above


def corpus(n=600):
    names = ["b", "a", "é", "Z", "zz", None, "a1"]
    share = [0, 0, 0, 0, 1, 2, 3, 4, 5, 6]
    return [(i, text(i, 1 + (i * 37) % 60), "en", names[share[i % 10]], 1) for i in range(n)]


def mixed(df):
    return mixing.mix(df).collect()


def test_targets_equal_the_rule(spark):
    rows = corpus()
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = brute_targets(sizes)
    got = mixed(docs(spark, rows))
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]


def test_taken_words_come_near_the_targets_and_follow_the_digest(spark):
    rows = corpus()
    got = mixed(docs(spark, rows))
    by_source = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["repeats"] * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    for rs in by_source.values():
        largest = max(r["size"] for r in rs)
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) <= largest / 2 + 1e-6
        # Nested thresholds: the documents taken once more are those of the smallest digests.
        order = sorted(rs, key=lambda r: hashlib.md5(str(r["doc_id"]).encode()).hexdigest())
        repeats = [r["repeats"] for r in order if r["size"]]
        assert repeats == sorted(repeats, reverse=True)


def test_reruns_and_partitions_agree(spark):
    rows = corpus(200)
    one = sorted((r["doc_id"], r["taken"]) for r in mixed(docs(spark, rows)))
    two = sorted((r["doc_id"], r["taken"]) for r in mixed(docs(spark, rows[::-1]).repartition(7)))
    assert one == two


def test_odd_rows(spark):
    rows = odd_rows()
    df = with_clashes(docs(spark, rows), "size", "target", "digest", "taken", "upto", "whole", "position")
    out = mixing.mix(df)
    got = out.collect()
    assert len(got) == len(rows)
    assert out.columns[: len(df.columns) - 3] == [c for c in df.columns if c not in ("size", "target", "taken")]
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}


def test_one_source_and_no_words(spark):
    one = mixed(docs(spark, [(i, text(i, 10)) for i in range(20)]))
    assert all(r["taken"] == r["size"] for r in one)
    assert [r["taken"] for r in mixed(docs(spark, [(1, ""), (2, None)]))] == [0, 0]


def test_empty_table(spark):
    assert mixed(empty(spark)) == []
