from __future__ import annotations

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from demandflow.operators import merge as mg
from demandflow.session import new_dir
from demandflow.sources.files import write_partitioned

SCHEMA = "date date, store bigint, sales double, promo int"


def frame(spark, *data):
    return spark.createDataFrame([(day(d), s, v, p) for d, s, v, p in data], SCHEMA)


def test_insert_only_keeps_existing_rows_and_is_idempotent(spark):
    target = frame(spark, (0, 1, 5.0, 0), (1, 1, 6.0, 0))
    source = frame(spark, (1, 1, 9.0, 1), (2, 1, 8.0, 0), (2, 1, 7.0, 0))
    once = mg.merge_insert_only(target, source, ["date", "store"])
    assert rows(once) == [(day(0), 1, 5.0, 0), (day(1), 1, 6.0, 0), (day(2), 1, 7.0, 0)]
    assert rows(mg.merge_insert_only(once, source, ["date", "store"])) == rows(once)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_upsert_same_with_small_and_large_source(spark, monkeypatch, limit):
    monkeypatch.setattr(mg, "is_small", lambda df: df.count() <= limit)
    target = frame(spark, (0, 1, 5.0, 0), (1, 1, 6.0, 0), (1, 2, 4.0, 0))
    source = frame(spark, (1, 1, None, 1), (3, 1, 8.0, 0))
    got = mg.merge_upsert(target, source, ["date", "store"])
    assert rows(got) == [(day(0), 1, 5.0, 0), (day(1), 1, None, 1), (day(1), 2, 4.0, 0), (day(3), 1, 8.0, 0)]
    assert rows(mg.merge_upsert(got, source, ["date", "store"])) == rows(got)
    only = mg.merge_upsert(target, source, ["date", "store"], update=["promo"])
    assert (day(1), 1, 6.0, 1) in rows(only)


def test_upsert_rejects_ambiguous_source(spark):
    target = frame(spark, (0, 1, 5.0, 0))
    with pytest.raises(ValueError, match="several rows"):
        mg.merge_upsert(target, frame(spark, (0, 1, 1.0, 0), (0, 1, 2.0, 0)), ["date", "store"])


def test_empty_source_changes_nothing(spark):
    target = frame(spark, (0, 1, 5.0, 0))
    empty = target.filter("false")
    assert rows(mg.merge_upsert(target, empty, ["date", "store"])) == rows(target)
    assert rows(mg.merge_insert_only(target, empty, ["date", "store"])) == rows(target)


def test_upsert_rewrites_only_touched_partitions(spark):
    path = new_dir(spark, "t")
    rows_ = [(m, k, float(m * 10 + k), t) for m in (1, 2, 3) for k in (1, 2) for t in ("x", "y")]
    table = spark.createDataFrame(rows_, "month int, k int, v double, t string").select("k", "v", "t", "month")
    write_partitioned(table, path, ["month"])

    def other_files():
        return {f for f in spark.read.parquet(path).inputFiles() if "month=2" not in f and "month=9" not in f}

    before = other_files()
    source = spark.createDataFrame([(1, 99.0, "x", 2), (5, 5.0, "x", 9)], table.schema)
    got = mg.upsert_partitions(path, table.schema, source, ["month", "k"], ["month"], ["v"], match=F.col("t") == "x")
    expected = {(k, 99.0 if (m, k, t) == (2, 1, "x") else v, t, m) for m, k, v, t in rows_} | {(5, 5.0, "x", 9)}
    assert {tuple(r) for r in got.collect()} == expected and got.count() == 13
    assert other_files() == before
    again = mg.upsert_partitions(path, table.schema, source, ["month", "k"], ["month"], ["v"], match=F.col("t") == "x")
    assert {tuple(r) for r in again.collect()} == expected
    assert mg.upsert_partitions(path, table.schema, source.filter("false"), ["month", "k"], ["month"]).count() == 13


def test_null_partitions_and_null_keys_survive_an_upsert(spark):
    path = new_dir(spark, "null_parts")
    old = spark.createDataFrame([(1, 10.0, "a"), (2, 20.0, "b"), (3, 30.0, None)], "id int, v double, part string")
    old.write.partitionBy("part").parquet(path)
    schema = old.schema
    new = spark.createDataFrame([(1, 11.0, "a"), (4, 40.0, None), (3, 31.0, None)], schema)
    for _ in range(2):
        out = mg.upsert_partitions(path, schema, new, ["id"], ["part"])
        assert rows(out) == [(1, 11.0, "a"), (2, 20.0, "b"), (3, 31.0, None), (4, 40.0, None)]
    target = spark.createDataFrame([(None, 1.0)], "k int, v double")
    source = spark.createDataFrame([(None, 2.0), (5, 3.0)], "k int, v double")
    once = mg.merge_upsert(target, source, ["k"])
    assert rows(mg.merge_upsert(once, source, ["k"])) == rows(once) == [(5, 3.0), (None, 2.0)]
    assert rows(mg.merge_insert_only(target, source, ["k"])) == [(5, 3.0), (None, 1.0)]
