"""Written tables and what is left of them on the disk."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from versemill import session


def moved(spark):
    """Shuffle files of the session."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for f in folders for p in Path(f.toString()).rglob("shuffle_*.data")}


def tables(spark):
    return set(Path(session.shared_root(spark).removeprefix("file:"), "versemill").glob("table-*"))


def test_what_was_moved_for_a_table_goes_when_it_is_written(spark):
    before, settings = moved(spark), [spark.conf.get(key, None) for key in session.CLEANUP]
    out = session.cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert moved(spark) <= before
    assert sorted(r["count"] for r in out.collect()) == [142, 143, 143, 143, 143, 143, 143]
    assert [spark.conf.get(key, None) for key in session.CLEANUP] == settings


def test_only_the_last_table_stays(spark):
    def make():
        first = session.cut_lineage(spark.range(10))
        second = session.settled(lambda: session.cut_lineage(first.filter("id > 2")).filter("id < 8"))
        return session.cut_lineage(second).join(first, "id")

    before = tables(spark)
    out = session.settled(make)
    assert sorted(r["id"] for r in out.collect()) == [3, 4, 5, 6, 7]
    assert len(tables(spark) - before) == 1


def test_tables_stay_where_a_step_fails(spark):
    def fails():
        kept.append(session.cut_lineage(spark.range(3)))
        raise ValueError("no")

    kept = []
    with pytest.raises(ValueError, match="no"):
        session.settled(fails)
    assert kept[0].count() == 3
    after = session.cut_lineage(spark.range(2))
    assert after.count() == 2 and session._written.paths == []
