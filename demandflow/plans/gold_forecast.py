"""The unified actual + forecast fact and its views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.operators.merge import merge_upsert, upsert_partitions
from demandflow.sources.contracts import FORECAST_FACT
from demandflow.sources.files import align_to_schema, with_month_partitions, write_partitioned

FORECAST_KEY = ("date", "family", "store_nbr", "model_name")
FACT_PARTITIONS = ("year", "month", "model_name")
STORED_FACT = T.StructType(
    [*FORECAST_FACT.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
)
REFRESHED = ("forecast", "model_version", "model_strategy", "best_iteration", "prediction_timestamp", "updated_at")


def _records(df: DataFrame, record_type: str, run_at: str) -> DataFrame:
    """Rows under the full fact schema; what a record type does not know is null."""
    at = F.lit(run_at).cast("timestamp_ntz")
    tagged = df.withColumns({"record_type": F.lit(record_type), "created_at": at, "updated_at": at})
    return align_to_schema(tagged, FORECAST_FACT)


def actual_records(sales: DataFrame, run_at: str) -> DataFrame:
    """M1: history as ``actual`` records, all of it training data."""
    return _records(sales.select("date", "family", "store_nbr", "sales", F.lit("train").alias("split")), "actual", run_at)


def forecast_records(predictions: DataFrame, run_at: str, models: Sequence[str] | None = None) -> DataFrame:
    """Predictions as ``forecast`` records, of the named models only if given."""
    if models is not None:
        predictions = predictions.filter(F.col("model_name").isin(*models))
    return _records(predictions.withColumnRenamed("prediction", "forecast").drop("sales"), "forecast", run_at)


def backtest_records(predictions: DataFrame, sales: DataFrame, run_at: str) -> DataFrame:
    """Predictions of days that have actuals, with both values."""
    actuals = sales.select("date", "family", "store_nbr", "sales")
    both = predictions.drop("sales").join(actuals, ["date", "family", "store_nbr"])
    return _records(both.withColumnRenamed("prediction", "forecast"), "backtest", run_at)


def sales_forecast_fact(sales: DataFrame, predictions: DataFrame, run_at: str) -> DataFrame:
    """M6: actual, backtest and forecast records as one table."""
    return (
        actual_records(sales, run_at)
        .unionByName(backtest_records(predictions, sales, run_at))
        .unionByName(forecast_records(predictions, run_at))
    )


def store_forecast_fact(
    target: str,
    sales: DataFrame,
    predictions: DataFrame,
    run_at: str,
    actuals: bool = True,
    backtests: bool = True,
    forecasts: bool = True,
) -> DataFrame:
    """Build the table in steps, the first replacing it and the others appending.

    Partitions are year, month and model: a partition per day and model would
    leave very small files.
    """
    steps = []
    if actuals:
        steps.append(actual_records(sales, run_at))
    if backtests:
        steps.append(backtest_records(predictions, sales, run_at))
    if forecasts:
        steps.append(forecast_records(predictions, run_at))
    mode = "overwrite"
    for records in steps:
        write_partitioned(with_month_partitions(records), target, FACT_PARTITIONS, mode)
        mode = "append"
    return read_forecast_fact(sales.sparkSession, target)


def read_forecast_fact(spark: SparkSession, target: str) -> DataFrame:
    """The stored fact with ``year`` and ``month`` left for pruning."""
    return spark.read.schema(STORED_FACT).parquet(target).select(*STORED_FACT.names)


def refresh_stored_forecasts(
    spark: SparkSession, target: str, predictions: DataFrame, model: str, run_at: str
) -> DataFrame:
    """M4 on the stored fact: only the months and the model of the new predictions are rewritten."""
    fresh = with_month_partitions(forecast_records(predictions, run_at, [model]))
    upsert_partitions(
        target, STORED_FACT, fresh, FORECAST_KEY, FACT_PARTITIONS, REFRESHED, match=F.col("record_type") == "forecast"
    )
    return read_forecast_fact(spark, target)


def refresh_forecasts(fact: DataFrame, predictions: DataFrame, model: str, run_at: str) -> DataFrame:
    """Replace the forecasts of one model in place and add its new ones; other records stay."""
    mine = (F.col("record_type") == "forecast") & F.col("model_name").eqNullSafe(F.lit(model))
    merged = merge_upsert(
        fact.filter(mine), forecast_records(predictions, run_at, [model]), FORECAST_KEY, REFRESHED
    )
    return fact.filter(~mine).unionByName(merged)


def latest_forecasts(fact: DataFrame) -> DataFrame:
    """The newest forecast per day, family, store and model, ties to the higher version."""
    w = Window.partitionBy("date", "family", "store_nbr", "model_name", "record_type").orderBy(
        F.desc("prediction_timestamp"), F.desc("model_version")
    )
    ranked = fact.filter("record_type = 'forecast'").withColumn("_rank", F.row_number().over(w))
    return ranked.filter("_rank = 1").drop("_rank")


def combined_view(fact: DataFrame) -> DataFrame:
    """Actuals and newest forecasts as one value column."""
    shown = ("date", "family", "store_nbr", "value", "data_type", "model_name", "model_version", "prediction_timestamp")
    forecasts = latest_forecasts(fact).withColumns(
        {
            "value": F.coalesce("sales", "forecast"),
            "data_type": F.when(F.col("sales").isNotNull(), "actual").otherwise("forecast"),
        }
    )
    actuals = fact.filter("record_type = 'actual'").withColumns(
        {"value": F.col("sales"), "data_type": F.lit("actual")}
    )
    return forecasts.select(*shown).unionByName(actuals.select(*shown))


def forecast_accuracy(fact: DataFrame) -> DataFrame:
    """Accuracy of the backtest records per model, version, family and store."""
    err = F.col("sales") - F.col("forecast")
    return (
        fact.filter("record_type = 'backtest'")
        .dropna(subset=["sales", "forecast"])
        .groupBy("model_name", "model_version", "family", "store_nbr")
        .agg(
            F.count(F.lit(1)).alias("num_predictions"),
            F.avg(F.abs(err)).alias("mae"),
            F.avg(F.abs(F.try_divide(err, F.col("sales")))).alias("mape"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.min("prediction_timestamp").alias("first_prediction_time"),
            F.max("prediction_timestamp").alias("last_prediction_time"),
        )
    )


def accuracy_rollup(accuracy: DataFrame, digits: int = 2) -> DataFrame:
    """Mean accuracy per model and family, rounded."""
    return accuracy.groupBy("model_name", "family").agg(
        F.sum("num_predictions").alias("total_predictions"),
        F.round(F.avg("mae"), digits).alias("avg_mae"),
        F.round(F.avg("mape") * 100, digits).alias("avg_mape_pct"),
        F.round(F.avg("rmse"), digits).alias("avg_rmse"),
    ).orderBy("model_name", "family")


def record_type_summary(fact: DataFrame) -> DataFrame:
    """Records and date range per record type and model."""
    return fact.groupBy("record_type", "model_name").agg(
        F.count(F.lit(1)).alias("record_count"), F.min("date").alias("min_date"), F.max("date").alias("max_date")
    )


def family_drilldown(fact: DataFrame, family: str, store_nbr: int, n: int = 10) -> DataFrame:
    """the newest backtest days of one family and store with percent error."""
    err = F.abs(F.col("sales") - F.col("forecast"))
    return (
        fact.filter((F.col("record_type") == "backtest") & (F.col("family") == family) & (F.col("store_nbr") == store_nbr))
        .select(
            "date",
            "store_nbr",
            F.col("sales").alias("actual"),
            "forecast",
            err.alias("absolute_error"),
            F.try_divide(err * 100, F.col("sales")).alias("pct_error"),
            "model_name",
            "model_version",
        )
        .orderBy(F.desc("date"), "model_name", "model_version")
        .limit(n)
    )


def future_forecasts(fact: DataFrame, as_of: str, n: int = 20) -> DataFrame:
    """the first forecasts from a given day on."""
    return (
        latest_forecasts(fact.filter(F.col("date") >= F.lit(as_of).cast("date")))
        .select("date", "family", "store_nbr", "forecast", "model_name", "model_version")
        .orderBy("date", "family", "store_nbr", "model_name")
        .limit(n)
    )


def sales_and_forecasts(actual: DataFrame, forecasts: DataFrame, validation: DataFrame) -> DataFrame:
    """M7: actuals, forecasts per scenario and validation predictions, each with its city, as one stack."""

    def stacked(df: DataFrame, value: str, data_type: Column) -> DataFrame:
        return df.select(
            "date", "store_nbr", "family", "city", F.col(value).alias("actual_sales"), data_type.alias("data_type")
        )

    scenario = F.concat(F.lit("Forecast - "), F.col("scenario"))
    return (
        stacked(actual, "sales", F.lit("Actual"))
        .unionByName(stacked(forecasts, "predicted_sales", scenario))
        .unionByName(stacked(validation, "predicted_sales", F.lit("Validation")))
    )
