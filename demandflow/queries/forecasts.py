"""The forecast fact, its views, scenarios and growth marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.plans import gold_forecast as gf
from demandflow.plans import growth
from demandflow.plans.models import scenario_features as what_if
from demandflow.queries import query
from demandflow.queries.common import RUN_AT, retail, rounded
from demandflow.session import materialize, new_dir


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    return gf.sales_forecast_fact(r.stored_sales, r.stored_predictions, RUN_AT)


@query
def sales_forecast_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _fact(spark, folder)


@query
def stored_forecast_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact written in three steps as a partitioned table and read back."""
    r = retail(spark, folder)
    return gf.store_forecast_fact(new_dir(spark, "gold_sales_forecast"), r.stored_sales, r.stored_predictions, RUN_AT)


@query
def refresh_stored_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """The retrained model's predictions merged into the stored fact, partition by partition."""
    r = retail(spark, folder)
    target = new_dir(spark, "gold_sales_forecast")
    gf.store_forecast_fact(target, r.stored_sales, r.stored_predictions, RUN_AT)
    return gf.refresh_stored_forecasts(spark, target, r.retrained_pred, "previous", "2002-03-01 00:00:00")


@query
def backtest_records(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    return gf.backtest_records(r.stored_predictions, r.stored_sales, RUN_AT)


@query
def refresh_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    latest = materialize(gf.latest_forecasts(_fact(spark, folder)), "forecasts")
    return gf.refresh_forecasts(latest, r.retrained_pred, "previous", "2002-03-01 00:00:00")


@query
def latest_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return gf.latest_forecasts(_fact(spark, folder))


@query
def combined_sales_view(spark: SparkSession, folder: str) -> DataFrame:
    return gf.combined_view(_fact(spark, folder))


@query
def forecast_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(gf.forecast_accuracy(_fact(spark, folder)), "mae", "mape", "rmse")


@query
def accuracy_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return gf.accuracy_rollup(gf.forecast_accuracy(_fact(spark, folder)))


@query
def record_type_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gf.record_type_summary(_fact(spark, folder))


@query
def family_drilldown(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(gf.family_drilldown(_fact(spark, folder), "PROMO", 1), "pct_error")


@query
def future_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    return gf.future_forecasts(_fact(spark, folder), "2001-10-15")


# --- scenarios and growth ------------------------------------------------------------------------


def _stack(spark: SparkSession, folder: str) -> DataFrame:
    """Actuals with their city, scenario forecasts and validation predictions."""
    r = retail(spark, folder)
    actual, forecasts, validation = (
        r.at_stores(df, "city", how="left") for df in (r.stored_sales, r.scenario_pred, r.validation_pred)
    )
    return gf.sales_and_forecasts(actual, forecasts, validation)


def _totals(spark: SparkSession, folder: str) -> tuple[DataFrame, growth.Period]:
    period = growth.Period.of(retail(spark, folder).last_sale, "last_date")
    return growth.scenario_totals(growth.ytd_segments(_stack(spark, folder), period)), period


@query
def scenario_features(spark: SparkSession, folder: str) -> DataFrame:
    return what_if(retail(spark, folder).future, "onpromotion", {"current": 1, "onpromotion_2x": 2})


@query
def sales_and_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    return _stack(spark, folder).orderBy("date", "family", "city", "store_nbr", "data_type")


@query
def data_type_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return growth.data_type_bounds(_stack(spark, folder))


@query
def ytd_segments(spark: SparkSession, folder: str) -> DataFrame:
    period = growth.Period.of(retail(spark, folder).last_sale, "last_date")
    return growth.ytd_segments(_stack(spark, folder), period)


@query
def scenario_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _totals(spark, folder)[0]


@query
def growth_by_city(spark: SparkSession, folder: str) -> DataFrame:
    totals, period = _totals(spark, folder)
    return rounded(growth.growth_by(totals, "city", period))


@query
def growth_by_family(spark: SparkSession, folder: str) -> DataFrame:
    totals, period = _totals(spark, folder)
    return rounded(growth.growth_by(totals, "family", period))


@query
def growth_of_sums(spark: SparkSession, folder: str) -> DataFrame:
    totals, period = _totals(spark, folder)
    return rounded(growth.growth_by(totals, "family", period, agg="sum"))


@query
def growth_delta(spark: SparkSession, folder: str) -> DataFrame:
    totals, period = _totals(spark, folder)
    return rounded(growth.growth_delta(growth.growth_by(totals, "family", period)))


@query
def family_year_pivot(spark: SparkSession, folder: str) -> DataFrame:
    sales = retail(spark, folder).stored_sales
    first, last = sales.agg(F.min(F.year("date")), F.max(F.year("date"))).first()
    return growth.family_year_pivot(sales, range(first, last + 1))
