from __future__ import annotations

from datetime import date

import pytest
from conftest import day, rows
from pyspark.sql import types as T

from demandflow.session import materialize, new_dir
from demandflow.sources import files
from demandflow.sources.contracts import DAILY_SALES, OIL, PRICE_FEED


@pytest.fixture
def sales(spark):
    data = [(date(2023, 12, 31), 1, "F", 1.5, 0), (day(0), 1, "F", 2.0, 1), (day(40), 2, "G", 3.0, None)]
    return spark.createDataFrame(data, DAILY_SALES)


def write_text(spark, path, lines):
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)


def test_csv_roundtrip_and_strictness(spark, sales):
    path = new_dir(spark, "csv")
    files.export_csv(sales, path)
    assert rows(files.load_csv(spark, path, DAILY_SALES)) == rows(sales)
    bad = new_dir(spark, "csv")
    write_text(spark, bad, ["date,dcoilwtico", "2024-01-01,50.5", "2024-01-02,oops"])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.load_csv(spark, bad, OIL.schema).collect()
    loose = files.load_csv(spark, bad, OIL.schema, mode="PERMISSIVE").cache()
    assert [r.dcoilwtico for r in loose.collect()] == [50.5, None]
    assert [r._corrupt_record for r in loose.collect()] == [None, "2024-01-02,oops"]


def test_ingest_replaces_the_target(spark):
    target = new_dir(spark, "bronze_oil")
    for price in ("50.5", "60.5"):
        source = new_dir(spark, "csv")
        write_text(spark, source, ["date,dcoilwtico", f"2024-01-01,{price}"])
        table = files.ingest_csv(spark, source, OIL, target)
    assert rows(table) == [(day(0), 60.5)]


def test_inferred_load_reports_missing(spark, sales):
    path = new_dir(spark, "csv")
    files.export_csv(sales, path)
    frames, missing = files.load_inferred(spark, {"sales": path, "gone": path + "-none"})
    assert missing == ["gone"] and dict(frames["sales"].dtypes)["sales"] == "double"


def test_append_matches_by_name(spark, sales):
    target = new_dir(spark, "t")
    sales.write.parquet(target)
    files.append_table(sales.select("onpromotion", "sales", "family", "store_nbr", "date"), target)
    assert spark.read.parquet(target).count() == 6
    assert rows(spark.read.parquet(target).distinct()) == rows(sales)


def test_partitions_are_pruned(spark, sales):
    target = new_dir(spark, "t")
    files.write_partitioned(files.with_month_partitions(sales), target)
    read = spark.read.parquet(target).filter("year = 2024 AND month = 1")
    assert [r.date for r in read.collect()] == [day(0)]
    plan = read._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_schema_evolution(spark, sales):
    old, new = new_dir(spark, "v1"), new_dir(spark, "v2")
    sales.drop("onpromotion").write.parquet(old)
    sales.write.parquet(new)
    both = files.read_evolving(spark, old, new)
    assert set(both.columns) == set(sales.columns) and both.filter("onpromotion = 1").count() == 1


def test_align_to_schema(spark):
    df = spark.createDataFrame([("7", "x", "2024-01-01")], "store_nbr string, sales string, date string")
    got = files.align_to_schema(df, DAILY_SALES)
    assert got.schema.names == DAILY_SALES.names and rows(got) == [(day(0), 7, None, None, None)]


def test_records_and_json(spark):
    frame = files.rows_to_frame(spark, [{"day": "2024-01-01", "price": "70.5"}, {"day": "2024-01-02"}], PRICE_FEED)
    assert rows(frame) == [(day(0), 70.5), (day(1), None)]
    path = new_dir(spark, "json")
    files.write_json_lines(frame, path)
    files.write_json_lines(frame, path)
    assert spark.read.schema(PRICE_FEED).json(path).count() == 4


def test_tagged_files_and_exports(spark):
    root = new_dir(spark, "metrics")
    schema = T.StructType.fromDDL("family string, r2 double")
    for name, value in (("one", 0.5), ("two", 0.7)):
        files.export_csv(spark.createDataFrame([("F", value)], schema), f"{root}/model_metrics_{name}")
    tagged = files.read_tagged_csv(spark, f"{root}/model_metrics_*", schema, "model_metrics_[a-z]+", "model")
    assert rows(tagged) == [("F", 0.5, "model_metrics_one"), ("F", 0.7, "model_metrics_two")]
    path = new_dir(spark, "single")
    files.export_parquet(tagged, path, single_file=True)
    assert len(spark.read.parquet(path).inputFiles()) == 1


def test_materialize_keeps_rows_and_schema(spark, sales):
    stored = materialize(sales, "t")
    assert stored.schema == sales.schema and rows(stored) == rows(sales)
    assert stored.inputFiles()
