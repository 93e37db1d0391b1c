"""Granularity, features, periods and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.operators import features as fe
from demandflow.operators import splits as sp
from demandflow.operators.quality import describe, missing_rows
from demandflow.plans import backtest as bt
from demandflow.plans import growth
from demandflow.plans.baselines import seasonal_naive as baseline
from demandflow.queries import query
from demandflow.queries.common import SERIES, STORE_SERIES, retail, rounded

LAGS = (1, 7, 14, 28, 56, 71)
SPANS = (7, 28)
STORE_MIN_DAYS = 90  # store and family series are short in the test data


@query
def aggregate_granularity(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    rows = r.at_stores(r.sales, "city").withColumn("top_promotion", F.col("onpromotion"))
    extra = {"onpromotion": "sum", "top_promotion": "max"}
    return fe.aggregate_to_granularity(rows, "date", "sales", ["city", "family"], "mean", extra)


@query
def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    series = retail(spark, folder).series
    return fe.build_features(series, "date", "sales", SERIES, LAGS, (), False, extra_aggs={"onpromotion": "sum"})


@query
def moving_averages(spark: SparkSession, folder: str) -> DataFrame:
    series = retail(spark, folder).series
    w = fe.series_window(SERIES)
    columns = {
        **fe.moving_average_columns("sales", w, SPANS),
        **fe.moving_average_columns("sales", w, SPANS, include_current=True, prefix="ma_with_current_"),
    }
    return rounded(series.withColumns(columns), *columns)


@query
def rolling_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(fe.rolling_stats(retail(spark, folder).series, SERIES))


@query
def series_features(spark: SparkSession, folder: str) -> DataFrame:
    sales = retail(spark, folder).sales
    return rounded(
        fe.build_features(sales, "date", "sales", STORE_SERIES, (1, 7, 14, 28), SPANS, extra_aggs={"onpromotion": "sum"}),
        "ma_7", "ma_28",
    )


@query
def dense_series(spark: SparkSession, folder: str) -> DataFrame:
    return fe.densify(retail(spark, folder).series, "date", SERIES, {"sales": 0.0, "onpromotion": 0})


@query
def active_period(spark: SparkSession, folder: str) -> DataFrame:
    return fe.active_period(retail(spark, folder).sales, STORE_SERIES)


@query
def stable_period(spark: SparkSession, folder: str) -> DataFrame:
    return fe.stable_period(fe.densify(retail(spark, folder).series, "date", SERIES, {"sales": 0.0}), SERIES)


@query
def trainable_series(spark: SparkSession, folder: str) -> DataFrame:
    stable = fe.stable_period(retail(spark, folder).sales, STORE_SERIES, span=10)
    return fe.trainable_series(stable, STORE_SERIES, STORE_MIN_DAYS).drop("stable_start_date")


@query
def sales_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(describe(retail(spark, folder).sales, "sales", ["family"]))


@query
def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    return fe.hash_sample(retail(spark, folder).sales, 0.1, ["date", "store_nbr", "family"])


@query
def seasonal_naive(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(baseline(retail(spark, folder).series, SERIES, (7, 14), (7,)), "prediction")


@query
def weekly_resample(spark: SparkSession, folder: str) -> DataFrame:
    return growth.weekly_resample(retail(spark, folder).sales, ["family"])


@query
def weekly_resample_by_store(spark: SparkSession, folder: str) -> DataFrame:
    return growth.weekly_resample(retail(spark, folder).sales, ["family", "store_nbr"])


# --- splits --------------------------------------------------------------------------------------


@query
def split_by_date(spark: SparkSession, folder: str) -> DataFrame:
    enough = sp.with_min_history(retail(spark, folder).series, SERIES, 56)
    return sp.split_by_date(enough, "2000-12-31")


@query
def split_horizon(spark: SparkSession, folder: str) -> DataFrame:
    return sp.split_horizon(retail(spark, folder).series, SERIES, 28, 1000)


@query
def split_train_val_test(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    return sp.split_train_val_test(r.series, 180, 30, last=r.last_sale)


@query
def split_shares(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    return rounded(sp.split_shares(sp.split_train_val_test(r.series, 180, 30, last=r.last_sale)))


@query
def short_groups(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    split = sp.split_train_val_test(r.sales, 180, 30, last=r.last_sale)
    return sp.short_groups(split, STORE_SERIES, 95)


@query
def split_last_days(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    return sp.split_last_days(r.sales, last=r.last_sale)


@query
def split_fraction(spark: SparkSession, folder: str) -> DataFrame:
    return sp.split_fraction(retail(spark, folder).sales, ["family"])


@query
def training_eligibility(spark: SparkSession, folder: str) -> DataFrame:
    rows = fe.rolling_stats(retail(spark, folder).series, SERIES)
    return sp.training_eligibility(rows, SERIES, ["sales_lag_30", "sales_rolling_std_7"])


@query
def set_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct (family, sales) pairs of the training days that the last 28 days lack."""
    r = retail(spark, folder)
    split = sp.split_last_days(r.sales, last=r.last_sale)
    pairs = split.select("split", "family", "sales")
    return missing_rows(sp.part(pairs, sp.TRAIN), sp.part(pairs, sp.VALIDATION))


# --- backtests -----------------------------------------------------------------------------------


@query
def backtest_folds(spark: SparkSession, folder: str) -> DataFrame:
    return bt.backtest_folds(retail(spark, folder).series, SERIES, 4, 14, 14)


@query
def backtest_naive(spark: SparkSession, folder: str) -> DataFrame:
    predictions = bt.naive_backtest(retail(spark, folder).series, SERIES, 4, 14, 14)
    return rounded(bt.backtest_metrics(predictions, SERIES))


@query
def backtest_naive_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping folds: a step shorter than the horizon."""
    return bt.naive_backtest(retail(spark, folder).series, SERIES, 5, 14, 7)
