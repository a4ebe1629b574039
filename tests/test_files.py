import json

import pytest
from pyspark.sql import functions as F

from versemill.session import shared_root, work_folder
from versemill.sources import files
from versemill.streaming.ingest import ingest_new_files, ingested, ledger


def test_work_folder_is_below_the_shared_root(spark):
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second and first.startswith(shared_root(spark))


def test_csv_keeps_quotes_lines_and_nulls(spark):
    rows = [(1, 'a "b", c\n  d '), (2, None), (3, " e")]
    df = spark.createDataFrame(rows, "id int, t string")
    path = work_folder(spark, "csv")
    files.write_csv(df, path)
    assert sorted(map(tuple, files.read_csv(spark, path, df.schema).collect())) == rows


def test_bad_response_lines_are_rejected(spark):
    good = {"custom_id": "request-7", "response": {"body": {"data": [{"embedding": [1.5, -2.0]}]}}}
    lines = [json.dumps(good), "", "not json", json.dumps({"custom_id": "request-8"})]
    path = work_folder(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    kept, rejected = files.read_responses(spark, path)
    assert [(r["id"], r["embedding"]) for r in kept.collect()] == [(7, [1.5, -2.0])]
    assert rejected.count() == 2


def test_id_lists_in_any_layout(spark):
    path = work_folder(spark, "ids")
    spark.createDataFrame([("[1, 22,\n 333]",), ("[4]",)], "value string").write.text(path)
    assert sorted(r["id"] for r in files.read_id_list(spark, path).collect()) == [1, 4, 22, 333]


def test_vectors_must_match_rows(spark):
    rows, vecs = spark.range(3).toDF("a"), spark.range(2).toDF("b")
    with pytest.raises(ValueError, match="1 rows without a vector"):
        files.align_vectors(rows, vecs, "a", "b")


def test_ingest_takes_each_file_once(spark):
    source, target = work_folder(spark, "in"), work_folder(spark, "out")
    batch = lambda a, b: spark.range(a, b).withColumn("t", F.lit("x")).coalesce(1)
    batch(0, 10).write.parquet(source)
    schema = batch(0, 1).schema
    for _ in range(2):
        ingest_new_files(spark, source, schema, target, "id", files_per_batch=1)
    assert ingested(spark, target).count() == 10
    batch(10, 25).write.mode("append").parquet(source)
    ingest_new_files(spark, source, schema, target, "id", files_per_batch=1)
    assert sorted(r["id"] for r in ingested(spark, target).collect()) == list(range(25))
    entries = ledger(spark, target).orderBy("start").collect()
    assert [(r["start"], r["end"], r["status"]) for r in entries] == [(0, 9, "completed"), (10, 24, "completed")]


def test_vectors_must_have_the_ids_of_the_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, t string")
    vectors = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (9, [2.0])], "vec_id long, v array<double>")
    lacking = files.lacking_partners(rows, vectors, "doc_id", "vec_id").collect()
    assert {(r["id"], r["lacks"]) for r in lacking} == {(3, "vector"), (9, "row")}
    with pytest.raises(ValueError, match="1 rows without a vector, 1 vectors without a row"):
        files.align_vectors(rows, vectors, "doc_id", "vec_id")
    same = files.align_vectors(rows.filter("doc_id < 3"), vectors.filter("vec_id < 3"), "doc_id", "vec_id")
    assert {(r["doc_id"], r["v"][0]) for r in same.collect()} == {(1, 0.0), (2, 1.0)}
