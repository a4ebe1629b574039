"""Most similar rows and greedy batches, against loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from versemill.operators import nearest, packing


def loop(sizes, max_rows, max_bytes):
    out, number, rows, size = [], 0, max_rows, 0
    for s in sizes:
        if rows == max_rows or size + s > max_bytes:
            number, rows, size = number + 1, 0, 0
        rows, size = rows + 1, size + s
        out.append(number)
    return out


@pytest.mark.parametrize("max_rows,max_bytes,range_rows", [(7, 300, 40), (50, 120, 11), (1, 10, 40), (30, 10**9, 9)])
def test_greedy_batches_equal_the_loop(spark, max_rows, max_bytes, range_rows):
    rng = random.Random(max_rows)
    rows = [(3 * i + 1, rng.choice([0, 0, 5, 40, 90, 400, None])) for i in range(230)]
    want = loop([s or 0 for _, s in rows], max_rows, max_bytes)
    rng.shuffle(shuffled := list(rows))
    got = packing.pack_greedy(spark.createDataFrame(shuffled, "id long, size long"), "id", "size", max_rows, max_bytes, range_rows)
    assert got.columns == ["id", "size", "batch"]
    assert [(r["id"], r["size"], r["batch"]) for r in got.orderBy("id").collect()] == [(*r, b) for r, b in zip(rows, want)]


def test_ways_through_a_range():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 3, 9]) for _ in range(rng.randrange(1, 40))]
        found = packing.ways_through(np.array(sizes), 6, 10)
        for first in range(min(6, len(sizes))):
            numbers = loop(sizes[first:], 6, 10)
            assert found["starts"][first] == numbers[-1]
            assert found["last"][first] == first + numbers.index(numbers[-1])


def test_greedy_batches_of_nothing(spark):
    assert packing.pack_greedy(spark.createDataFrame([], "id long, size long"), "id", "size", 3, 10).count() == 0


def by_definition(rows, n):
    out = []
    for i, (g, v) in rows.items():
        near = []
        for j, (h, w) in rows.items():
            if g is not None and v is not None and w is not None and g == h and i != j:
                length = np.linalg.norm(v) * np.linalg.norm(w)
                near.append((-round(float(np.dot(v, w) / length) if length else 0.0, nearest.PLACES), j))
        out += [(i, j, -s, k) for k, (s, j) in enumerate(sorted(near)[:n], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [4, 1000])
def test_most_similar_equals_all_pairs(spark, block_rows):
    rng = random.Random(8)
    rows = {}
    for i in range(120):
        vector = [float(rng.randrange(-2, 3)) for _ in range(3)]  # many equal vectors, some without length
        rows[i * 7] = (rng.choice(["a", "a", "a", "b", "c", None]), None if i % 40 == 9 else vector)
    rows[5000] = ("alone", [1.0, 0.0, 0.0])
    df = spark.createDataFrame([(i, g, v, 1.5) for i, (g, v) in rows.items()], "vec_id long, g string, v array<double>, id double")
    got = nearest.most_similar(df, "vec_id", "v", 3, ["g"], block_rows).collect()
    assert sorted((r["id"], r["neighbour"], r["similarity"], r["place"]) for r in got) == by_definition(rows, 3)


def test_a_row_is_moved_to_few_blocks(spark, monkeypatch):
    sizes = [0, 1, 1000, 20_000, 100_000, 600_000, 768_000, 1_000_000]
    rows = spark.createDataFrame([(n,) for n in sizes], "n long").select(nearest.blocks_of(F.col("n"), 1000).alias("b"), "n").orderBy("n").collect()
    assert [r["b"] for r in rows] == [0, 1, 1, 20, 24, 24, 24, 32]
    monkeypatch.setattr(nearest, "CELLS", 50)
    monkeypatch.setattr(nearest, "MOST_BLOCKS", 3)
    rng = random.Random(2)
    held = {i: ("a", [float(rng.randrange(-2, 3)) for _ in range(3)]) for i in range(90)}
    df = spark.createDataFrame([(i, v) for i, (_, v) in held.items()], "id long, v array<double>")
    got = nearest.most_similar(df, "id", "v", 3, block_rows=4).collect()
    assert sorted((r["id"], r["neighbour"], r["similarity"], r["place"]) for r in got) == by_definition(held, 3)


def test_most_similar_of_equal_vectors(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "id long, v array<double>")
    got = nearest.most_similar(df, "id", "v", 2, block_rows=6).collect()
    want = {(i, *[j for j in range(3) if j != i][:2]) for i in range(50)}
    places = {}
    for r in sorted(got, key=lambda r: r["place"]):
        places.setdefault(r["id"], []).append(r["neighbour"])
    assert {(i, *held) for i, held in places.items()} == want


def test_most_similar_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, v array<double>, g string")
    assert nearest.most_similar(empty, "id", "v", 2).count() == 0
    assert nearest.most_similar(empty, "id", "v", 2, ["g"]).count() == 0
