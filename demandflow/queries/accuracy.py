"""Metrics, comparisons and error analysis on exact baseline predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.operators import drift as dr
from demandflow.operators import metrics as m
from demandflow.operators import splits as sp
from demandflow.plans.baselines import seasonal_naive
from demandflow.plans.models import compare_models
from demandflow.queries import query
from demandflow.queries.common import SERIES, retail, rounded


def _stacked(spark: SparkSession, folder: str) -> DataFrame:
    """Baseline predictions of all models with train, validation and test rows."""
    stacked = seasonal_naive(retail(spark, folder).series, SERIES, (7, 14, 28), (7,))
    return sp.split_train_val_test(stacked, 180, 30)


def _pred_split(spark: SparkSession, folder: str) -> DataFrame:
    return sp.split_train_val_test(retail(spark, folder).pred, 180, 30)


@query
def metrics_by_series(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.metrics_by_series(retail(spark, folder).pred, SERIES))


@query
def metrics_portfolio(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.metrics_portfolio(retail(spark, folder).pred, SERIES))


@query
def metrics_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Series, families, states and portfolio together."""
    levels = [SERIES, SERIES[:1], SERIES[1:], ()]
    return rounded(m.metrics_levels(retail(spark, folder).pred, SERIES, levels))


@query
def portfolio_long(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.metrics_long(m.metrics_portfolio(retail(spark, folder).pred, SERIES)))


@query
def wmape_by_family(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.wmape_spread(m.metrics_by_series(retail(spark, folder).pred, SERIES)))


@query
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.regression_metrics(retail(spark, folder).pred))


@query
def worst_best_groups(spark: SparkSession, folder: str) -> DataFrame:
    by_series = m.regression_metrics(retail(spark, folder).pred, SERIES)
    return rounded(m.worst_and_best(by_series, 5, SERIES))


@query
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(compare_models(_stacked(spark, folder)))


@query
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    validation = sp.part(_stacked(spark, folder), sp.VALIDATION)
    return rounded(m.best_model(m.regression_metrics(validation, ["model_name"])))


@query
def rmsle(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.rmsle(_pred_split(spark, folder), ["split"]))


@query
def split_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.split_metrics(_stacked(spark, folder), ["model_name"]))


@query
def overfit_flag(spark: SparkSession, folder: str) -> DataFrame:
    flagged = m.overfit_flag(m.split_metrics(_pred_split(spark, folder), ["family"]))
    return rounded(flagged.select("family", "train_rmse", "validation_rmse", "possible_overfit"))


@query
def error_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.error_by_date(_pred_split(spark, folder)))


@query
def split_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.split_summary(_pred_split(spark, folder)))


EDGES = (5.0, 10.0, 20.0, 40.0, 80.0)


@query
def drift_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the training and test part by bin."""
    edges = {"y": EDGES, "prediction": EDGES}
    base, other = F.col("split") == "train", F.col("split") == "test"
    return dr.bin_counts(_pred_split(spark, folder), edges, base, other)


@query
def drift_report(spark: SparkSession, folder: str) -> DataFrame:
    """How far actuals and predictions of the test part have moved from the training part."""
    edges = {"y": EDGES, "prediction": EDGES}
    return rounded(dr.split_drift(_pred_split(spark, folder), ["y", "prediction"], edges=edges))


@query
def forecast_errors(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.forecast_errors(retail(spark, folder).pred), "pct_error")


@query
def prediction_sample(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.prediction_sample(retail(spark, folder).pred, ["date", "family", "state"]), "pct_error")


def _family_errors(spark: SparkSession, folder: str) -> DataFrame:
    return m.forecast_errors(m.family_daily(retail(spark, folder).pred))


@query
def error_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.error_summary(_family_errors(spark, folder)))


@query
def family_error_summary(spark: SparkSession, folder: str) -> DataFrame:
    return m.family_error_summary(_family_errors(spark, folder))


@query
def family_groups(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.family_groups(_family_errors(spark, folder)))


@query
def crosstab_pct(spark: SparkSession, folder: str) -> DataFrame:
    errors = m.forecast_errors(retail(spark, folder).pred)
    return rounded(m.crosstab_pct(errors, "family", "day_of_week", range(7)))


@query
def topk_values(spark: SparkSession, folder: str) -> DataFrame:
    return m.topk_values(retail(spark, folder).series, "state", "family", 3)


@query
def validation_residuals(spark: SparkSession, folder: str) -> DataFrame:
    return m.residuals(retail(spark, folder).validation_pred)


@query
def daily_actual_vs_pred(spark: SparkSession, folder: str) -> DataFrame:
    return m.actual_vs_predicted(retail(spark, folder).validation_pred, ["date"])


@query
def weekly_actual_vs_pred(spark: SparkSession, folder: str) -> DataFrame:
    return m.weekly_actual_vs_predicted(retail(spark, folder).pred, y="y", prediction="prediction")


@query
def top_families_daily(spark: SparkSession, folder: str) -> DataFrame:
    return m.top_groups_daily(retail(spark, folder).pred, "family", 3, "y", "prediction")


@query
def baseline_prediction_range(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.prediction_range(_stacked(spark, folder), ["model_name", "split"]))


@query
def baseline_fleet(spark: SparkSession, folder: str) -> DataFrame:
    by_family = m.regression_metrics(retail(spark, folder).pred, ["family"])
    return rounded(m.fleet_summary(by_family, "family"))
