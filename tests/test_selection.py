"""Values at ranks, against a sorted list."""

import math
import random

import pytest
from pyspark.sql import functions as F

from versemill.operators import ranking

COLUMNS = {
    "even": lambda r: r.uniform(0, 1),
    "few": lambda r: float(r.randrange(4)),
    "one": lambda r: 7.5,
    "wide": lambda r: r.choice([-1, 1]) * 10.0 ** r.randrange(-320, 309),
    "largest": lambda r: r.choice([-1.7e308, 1.7e308, 0.0, 1e300]),
    "odd.name": lambda r: r.choice([None, 1.0, 2.5, math.inf, -math.inf, math.nan, r.gauss(0, 1)]),
    "none": lambda r: None,
    "endless": lambda r: math.inf,
}


def in_order(values):
    return sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v if not math.isnan(v) else 0.0))


@pytest.mark.parametrize("cells", [4096, 8])
def test_values_at_all_ranks(spark, monkeypatch, cells):
    monkeypatch.setattr(ranking, "CELLS", cells)
    rng = random.Random(cells)
    rows = [tuple(make(rng) for make in COLUMNS.values()) for _ in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in COLUMNS))
    found = ranking.values_at_ranks(df, lambda n: list(range(0, n, 7)) + [n - 1])
    want = {c: in_order(v) for c, v in zip(COLUMNS, zip(*rows))}
    assert set(found) == {c for c, v in want.items() if v}
    for c, (n, at) in found.items():
        assert n == len(want[c])
        assert {k: repr(v + 0.0) for k, v in at.items()} == {k: repr(want[c][k] + 0.0) for k in {*range(0, n, 7), n - 1}}


def test_percentiles_of_many_rows(spark):
    df = spark.range(20_001).select((F.col("id") * F.col("id")).alias("x"), (F.col("id") % 3).alias("y"))
    got = ranking.exact_percentiles(df, {"x": F.col("x"), "y": F.col("y")}, [0.0, 0.05, 0.5, 1.0])
    assert got == {"x": [0.0, 1000.0**2, 10_000.0**2, 20_000.0**2], "y": [0.0, 0.0, 1.0, 2.0]}


def test_percentiles_of_nothing(spark):
    assert ranking.exact_percentiles(spark.createDataFrame([], "x double"), {"x": F.col("x")}, [0.5]) == {}
