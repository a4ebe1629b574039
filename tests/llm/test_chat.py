import itertools
import random

import numpy as np
import pytest
from helpers import empty
from pyspark.sql import functions as F

from versemill.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(roles):
    """Least cost over every choice for every turn, by plain recursion."""
    from functools import cache

    @cache
    def rest(i, state):
        if i == len(roles):
            return int(chat.END_COST[state])
        code = chat.role_code(roles[i])
        out = []
        if state != chat.START:
            change = 0 if code == state else chat.RELABEL_UNKNOWN if code == chat.UNKNOWN else chat.RELABEL
            out.append(chat.MERGE + change + rest(i + 1, state))
        for k in range(4):
            for path in itertools.product(range(1, 5), repeat=k):
                at, legal = state, True
                for s in path:
                    legal = legal and s in chat.LEGAL[at]
                    at = s
                if legal:
                    for after in chat.LEGAL[at]:
                        change = 0 if code == after else chat.RELABEL_UNKNOWN if code == chat.UNKNOWN else chat.RELABEL
                        out.append(chat.INSERT * k + change + rest(i + 1, after))
        return min(out)

    return rest(0, chat.START)


def repaired(df):
    rows = sorted(chat.repair(df).collect(), key=lambda r: (r["seg"], r["pos"]))
    out = {}
    for r in rows:
        out.setdefault(r["conv_id"], []).append(r)
    return out


def legal(rows):
    state = chat.START
    for r in rows:
        after = chat.ROLES.index(r["new_role"]) + 1
        for name in r["inserted"]:
            assert chat.ROLES.index(name) + 1 in chat.LEGAL[state]
            state = chat.ROLES.index(name) + 1
        if r["action"] == "merge":
            assert after == state and not r["inserted"]
        else:
            assert after in chat.LEGAL[state]
        state = after
    for name in rows[-1]["appended"]:
        assert chat.ROLES.index(name) + 1 in chat.LEGAL[state]
        state = chat.ROLES.index(name) + 1
    return state in chat.FINAL


def conversations(seed, n):
    rng = random.Random(seed)
    kinds = ["user", "assistant", "system", "tool", "Human", None, "narrator", " GPT "]
    return {c: [rng.choice(kinds) for _ in range(rng.randrange(1, 9))] for c in range(n)}


def frame(spark, convs):
    rows = [(c, i, r, f"t{c}.{i}") for c, roles in convs.items() for i, r in enumerate(roles)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("segment", [256, 2])
def test_cost_is_least_and_order_legal(spark, monkeypatch, segment):
    monkeypatch.setattr(chat, "SEGMENT", segment)
    monkeypatch.setattr(chat, "FAN_BITS", 1)
    convs = conversations(1, 60)
    got = repaired(frame(spark, convs))
    assert set(got) == set(convs)
    for c, roles in convs.items():
        assert [r["turn"] for r in got[c]] == list(range(len(roles)))
        assert legal(got[c])
        assert sum(r["cost"] for r in got[c]) == cheapest(tuple(roles))


def test_rendered_text(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "bot", None), (2, 0, "assistant", "x"), (2, 1, "user", "y")]
    got = repaired(spark.createDataFrame(rows, SCHEMA))
    one = "".join(r["rendered"] for r in got[1])
    assert one == "<|user|>\na\nb\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert [r["action"] for r in got[1]] == ["keep", "merge", "keep"]
    assert "".join(r["rendered"] for r in got[2]).count("<|end|>") == "".join(r["rendered"] for r in got[2]).count("<|") // 2


def test_a_long_conversation_is_split(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 16)
    monkeypatch.setattr(chat, "FAN_BITS", 2)
    rng = random.Random(4)
    roles = [rng.choice(["user", "assistant", "tool", None]) for _ in range(3000)]
    rows = [(1, i, r, "t") for i, r in enumerate(roles)] + [(2, i, "user", "u") for i in range(40)]
    got = repaired(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert len({r["seg"] for r in got[1]}) > 100
    assert legal(got[1]) and legal(got[2])
    matrices = [chat.STEP[chat.role_code(r)] for r in roles]
    whole = chat.product(matrices)
    assert sum(r["cost"] for r in got[1]) == int((whole[chat.START] + chat.END_COST).min())


def test_products_are_associative():
    rng = np.random.default_rng(0)
    a, b, c = rng.integers(0, 20, (3, 5, 5))
    assert (chat.times(chat.times(a, b), c) == chat.times(a, chat.times(b, c))).all()


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no id"), (None, 1, None, None), (1, None, "user", "no turn"), (1, 0, "user", ""),
        (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", "tie"), (3, 5, "x" * 50, "y" * 100_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("clash") for n in ("seg", "pos", "matrix", "entry", "rendered", "_text")})
    got = repaired(df)
    assert {c: len(r) for c, r in got.items()} == {None: 2, 1: 2, 2: 3, 3: 1}
    assert all(legal(r) for r in got.values())


def test_empty_table(spark):
    assert chat.repair(empty(spark, SCHEMA)).collect() == []
