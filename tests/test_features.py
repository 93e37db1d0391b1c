from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from demandflow.operators import features as fe


@pytest.fixture
def series(spark):
    data = [("x", day(n), float(n * n % 11), n % 2) for n in range(40)] + [("y", day(3), 4.0, 0)]
    return spark.createDataFrame(data, "s string, date date, sales double, onpromotion int")


def test_aggregate_to_granularity(spark):
    df = spark.createDataFrame([("x", day(0), 1.0, 2.0), ("x", day(0), 3.0, 4.0)], "s string, date date, sales double, oil double")
    got = fe.aggregate_to_granularity(df, "date", "sales", ["s"], "sum", {"oil": "mean"})
    assert rows(got) == [("x", day(0), 4.0, 3.0)]
    with pytest.raises(ValueError, match="unknown aggregate"):
        fe.aggregate_to_granularity(df, "date", "sales", ["s"], "median")
    with pytest.raises(ValueError, match="unknown aggregate"):
        fe.aggregate_to_granularity(df, "date", "sales", ["s"], "sum", {"oil": "mode"})


def test_build_features_against_pandas_and_without_leakage(series):
    got = fe.build_features(series, "date", "sales", ["s"], [1, 7], [3]).toPandas().sort_values("date")
    full = series.filter("s = 'x'").toPandas().sort_values("date")["sales"]
    assert list(got["s"].unique()) == ["x"] and len(got) == 40 - 7
    np.testing.assert_allclose(got["lag_7"], full.shift(7)[7:])
    np.testing.assert_allclose(got["ma_3"], full.shift(1).rolling(3).mean()[7:])
    # The target of a row must not change any of its features.
    changed = series.withColumn("sales", F.when(F.col("date") == day(39), 1e6).otherwise(F.col("sales")))
    features = ["lag_1", "lag_7", "ma_3"]
    before, after = (
        fe.build_features(d, "date", "sales", ["s"], [1, 7], [3]).filter(F.col("date") == day(39)).select(*features)
        for d in (series, changed)
    )
    assert rows(before) == rows(after)


def test_moving_average_with_current_row_on_request(series):
    w = fe.series_window(["s"])
    columns = fe.moving_average_columns("sales", w, [3], include_current=True)
    got = series.filter("s = 'x'").withColumns(columns).toPandas().sort_values("date")
    np.testing.assert_allclose(got["ma_3"], got["sales"].rolling(3, min_periods=1).mean())


def test_rolling_stats_against_pandas(series):
    got = fe.rolling_stats(series, ["s"]).filter("s = 'x'").toPandas().sort_values("date")
    prior = got["sales"].shift(1)
    np.testing.assert_allclose(got["sales_rolling_std_7"], prior.rolling(7, min_periods=2).std())
    np.testing.assert_allclose(got["sales_rolling_mean_14"], prior.rolling(14, min_periods=1).mean())
    np.testing.assert_allclose(
        got["promo_rolling_sum_7"].astype(float), got["onpromotion"].shift(1).rolling(7, min_periods=1).sum()
    )
    single = fe.rolling_stats(series, ["s"]).filter("s = 'y'").first()
    assert single.sales_rolling_std_7 is None and single.sales_lag_7 is None


def test_unique_check(series):
    fe.build_features(series, "date", "sales", ["s"], pre_aggregate=False, check_unique=True)
    with pytest.raises(ValueError, match="several rows"):
        fe.build_features(series.union(series), "date", "sales", ["s"], pre_aggregate=False, check_unique=True)


def test_densify(spark):
    df = spark.createDataFrame(
        [("x", day(0), 1.0, None), ("x", day(3), 2.0, 5), ("y", day(9), 3.0, 6)], "s string, date date, sales double, n int"
    )
    assert rows(fe.densify(df, "date", ["s"], {"sales": 0.0})) == [
        ("x", day(0), 1.0, None), ("x", day(1), 0.0, None), ("x", day(2), 0.0, None), ("x", day(3), 2.0, 5), ("y", day(9), 3.0, 6),
    ]


def test_periods(spark):
    sales = [0.0, 0.0, 3.0, 0.0, 2.0, 1.0, 1.0, 0.0]
    df = spark.createDataFrame(
        [("x", day(n), v) for n, v in enumerate(sales)] + [("never", day(0), 0.0)], "s string, date date, sales double"
    )
    active = fe.active_period(df, ["s"])
    assert active.count() == 6 and active.first().active_start_date == day(2)
    stable = fe.stable_period(df, ["s"], span=3, needed=2)
    assert [r.date for r in stable.orderBy("date").collect()] == [day(4), day(5), day(6), day(7)]


def test_trainable_series_equals_semi_join(spark):
    df = spark.createDataFrame(
        [("a", day(n // 2), 1.0) for n in range(10)] + [("b", day(n), 1.0) for n in range(9)] + [("c", day(n), -1.0) for n in range(9)],
        "s string, date date, sales double",
    )
    for days in (5, 6, 9, 10):
        keep = fe.sufficient_series(df, ["s"], days).select("s")
        assert rows(fe.trainable_series(df, ["s"], days)) == rows(df.join(keep, "s", "left_semi"))


def test_hash_sample_ignores_partitioning(spark):
    df = spark.range(20000).withColumn("v", F.col("id") * 2)
    sample = fe.hash_sample(df, 0.1, ["id"])
    assert rows(sample) == rows(fe.hash_sample(df.repartition(7), 0.1, ["id"]))
    assert 1800 < sample.count() < 2200
    assert rows(sample) != rows(fe.hash_sample(df, 0.1, ["id"], seed=1))


def test_feature_columns(series):
    assert fe.numeric_features(series, ["s", "date", "sales"]) == ["onpromotion"]
    assert fe.existing(["lag_1", "sales", "onpromotion"], series) == ["sales", "onpromotion"]


def test_lags_count_observations(spark):
    df = spark.createDataFrame([("x", day(n), float(n)) for n in (0, 5, 9)], "s string, date date, sales double")
    got = df.withColumns(fe.lag_columns("sales", fe.series_window(["s"]), [1])).toPandas().sort_values("date")
    assert pd.isna(got["lag_1"].iloc[0]) and list(got["lag_1"].iloc[1:]) == [0.0, 5.0]
