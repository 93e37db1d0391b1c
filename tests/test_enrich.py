from __future__ import annotations

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from demandflow.operators import encode as en
from demandflow.operators.enrich import enrich, gold_daily_fact
from demandflow.session import dimension_join, materialize_all, scratch_root
from demandflow.settings import cluster_settings, shuffle_partitions


@pytest.fixture
def dims(spark):
    stores = spark.createDataFrame(
        [(1, "Q", "North", "A", 3), (2, "G", "South", "B", 4)],
        "store_nbr bigint, city string, state string, type string, cluster int",
    )
    holidays = spark.createDataFrame(
        [(day(0), "North", 1), (day(0), "South", 0), (day(1), "North", 0)], "date date, state string, is_holiday int"
    )
    oil = spark.createDataFrame([(day(0), 50.0)], "date date, dcoilwtico double")
    sales = spark.createDataFrame(
        [(1, day(0), 1, "F", 2.0, 0), (2, day(0), 2, "F", 3.0, 1), (3, day(1), 1, "E", 4.0, 0), (4, day(0), 9, "F", 5.0, 0)],
        "id bigint, date date, store_nbr bigint, family string, sales double, onpromotion int",
    )
    return sales, stores, holidays, oil


def test_gold_fact_has_one_row_per_sale_and_the_holiday_of_its_state(dims):
    got = {r.id: r for r in gold_daily_fact(*dims).collect()}
    assert len(got) == 4
    assert (got[1].is_holiday, got[2].is_holiday, got[3].is_holiday, got[4].is_holiday) == (1, 0, 0, 0)
    assert got[3].dcoilwtico is None and got[4].city is None and got[1].store_type == "A"
    assert (got[1].day_of_week, got[1].is_weekend, got[1].week_of_year) == (2, 0, 1)


def test_gold_fact_with_transactions(spark, dims):
    transactions = spark.createDataFrame([(day(0), 1, 7)], "date date, store_nbr bigint, transactions int")
    got = {r.id: r.transactions for r in gold_daily_fact(*dims, transactions).collect()}
    assert got == {1: 7, 2: None, 3: None, 4: None}


def test_enrich_drops_rows_without_store_or_price(spark, dims):
    sales, stores, holidays, oil = dims
    values = en.category_values(sales.join(stores, "store_nbr"), ["family", "city", "state", "type"])
    got = enrich(sales, stores, holidays, oil, en.category_codes(values))
    assert sorted(r.id for r in got.collect()) == [1, 2]
    assert {(r.city, r.city_code, r.family_code) for r in got.collect()} == {("Q", 1, 1), ("G", 0, 1)}


def test_codes_are_sorted_and_unseen_values_get_the_next_code(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "family string")
    codes = en.category_codes(en.category_values(df, ["family"]))
    assert rows(codes) == [("family", "a", 0), ("family", "b", 1), ("family", "c", 2)]
    later = spark.createDataFrame([("c",), ("new",), (None,)], "family string")
    assert {r.family: r.family_code for r in en.encode(later, codes, ["family"]).collect()} == {"c": 2, "new": 3, None: None}


def test_numbering_without_a_window_equals_the_window(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("big"), (F.col("id") % 3).cast("string").alias("small")
    )
    values = en.category_values(df, ["big", "small"])
    assert rows(en.number_sorted(values)) == rows(en.category_codes(values))


def test_hashed_features_has_fixed_size(dims):
    sales = dims[0]
    vectors = [r.hash_features for r in en.hashed_features(sales, ["family"]).collect()]
    assert {v.size for v in vectors} == {1024} and {v.numNonzeros() for v in vectors} == {1}


def test_dimension_join_broadcasts_only_below_the_limit(dims):
    sales, stores, *_ = dims

    def plan(df):
        return df._jdf.queryExecution().toString()

    assert "BroadcastHashJoin" in plan(dimension_join(sales, stores, "store_nbr"))
    spark = sales.sparkSession
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = dimension_join(sales, stores, "store_nbr", max_rows=1)
        assert "BroadcastHashJoin" not in plan(big) and "SortMergeJoin" in plan(big)
        assert rows(big) == rows(dimension_join(sales, stores, "store_nbr"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_scratch_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    assert root == configured.rstrip("/") if configured else root == scratch_root(spark)


def test_written_side_by_side(spark):
    frames = {"a": spark.range(5), "b": spark.range(7)}
    written = materialize_all(frames)
    assert {n: df.count() for n, df in written.items()} == {"a": 5, "b": 7} and materialize_all({}) == {}


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(1 << 40, 8) == 5243
    assert shuffle_partitions(100 << 40, 4000) == 50_000
    settings = cluster_settings("hdfs:///shared", 1 << 40, 100)
    assert settings["spark.checkpoint.dir"] == "hdfs:///shared" and settings["spark.sql.shuffle.partitions"] == "5243"
