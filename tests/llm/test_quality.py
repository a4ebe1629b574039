import random
import re
from collections import Counter

import pytest
from helpers import docs, empty, odd_rows, text, with_clashes

from versemill.llm import quality

WORD = r"[^\x20\x09-\x0D]+"


def brute(t):
    t = t or ""
    ws = re.findall(WORD, t)
    grams = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    covered = {i + k for i in range(len(ws) - 7) if grams[tuple(ws[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    n_symbols = sum(c in "#*$%&|<>" for c in t)
    failed = len(ws) < 20 or 100 * len(covered) > 30 * len(ws)
    return len(ws), sum(map(len, ws)), n_symbols, len(lines) - len(set(lines)), len(covered), failed


def counted(df):
    return [(r["id"], *[r[c] for c in quality.COUNTS], r["base_failed"]) for r in quality.apply_rules(df).collect()]


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        part = text(i, 30, 5 if i % 3 else 500)
        t = "\n".join(rng.choice([part, text(i + 1000, 12), "", "# * $ % & | < > é漢"]) for _ in range(rng.randrange(1, 6)))
        rows.append((i, t))
    rows += [r[:2] for r in odd_rows()]
    df = with_clashes(docs(spark, rows), "id", "host", "n_words", "failed", "rate", "kept")
    assert sorted(counted(df), key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_pieces_of_a_batch_do_not_mix(spark, monkeypatch):
    from versemill.llm import common

    rows = [(i, text(7, 40)) for i in range(30)]
    monkeypatch.setattr(quality, "pieces", lambda texts: common.pieces(texts, 300))
    assert {r[5] for r in counted(docs(spark, rows))} == {0}


def judged(spark, hosts):
    rows = [(h, i < bad) for h, (n, bad) in hosts.items() for i in range(n)]
    return spark.createDataFrame(rows, "host string, failed boolean")


def test_small_hosts_are_drawn_to_the_mean_and_large_ones_are_not(spark):
    hosts = {f"h{k}": (200, 10 + k % 7) for k in range(30)} | {"bad": (1000, 900), "tiny": (1, 1), None: (50, 0)}
    got = {r["host"]: r for r in quality.host_verdicts(judged(spark, hosts)).collect()}
    assert got["bad"]["rate"] == pytest.approx(0.9, abs=0.01) and not got["bad"]["host_kept"]
    assert got["tiny"]["rate"] < 0.95 and 0 < got[None]["rate"] < 0.02


def test_hosts_that_differ_by_chance_get_the_mean(spark):
    got = quality.host_verdicts(judged(spark, {f"h{k}": (10, 1 + k % 2) for k in range(20)})).collect()
    assert {round(r["rate"], 9) for r in got} == {0.15} and all(r["host_kept"] for r in got)


def test_verdict_on_a_host_reaches_its_documents(spark):
    rows = [(i, "short", "en", "bad", 5) for i in range(300)] + [(1000 + i, text(i, 30), "en", "bad" if i < 3 else "good", 1) for i in range(300)]
    got = {r["id"]: (r["base_failed"], r["kept"]) for r in quality.apply_rules(docs(spark, rows)).collect()}
    assert got[0] == (True, False) and got[1000] == (False, False) and got[1200] == (False, True)


def test_empty_table(spark):
    assert counted(empty(spark)) == []
