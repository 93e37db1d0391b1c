"""Forecast accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.functions.calendar import iso_calendar, week_start
from demandflow.functions.scalars import guarded_pct_error, pct_error, ratio
from demandflow.operators.features import series_window

OVERFIT_RATIO = 0.7  # fixed value


def _error(y: str, prediction: str) -> Column:
    return F.col(y) - F.col(prediction)


# --- scale-free metrics per series and over all -------------------------------------------------


def _scale_free(y: str, prediction: str) -> list[Column]:
    size = F.abs(F.col(y)) + F.abs(F.col(prediction))
    abs_err = F.abs(_error(y, prediction))
    smape = F.when(size > 0, abs_err / (size / 2)).when(size == 0, 0.0)  # null without a prediction
    return [
        F.avg(smape).alias("sMAPE"),
        ratio(F.sum(abs_err), F.sum(F.when(abs_err.isNotNull(), F.col(y)))).alias("wMAPE"),
        ratio(F.avg(abs_err), F.avg(F.abs(F.col(y) - F.col("_naive")))).alias("MASE"),
    ]


def _with_naive(
    df: DataFrame, group_cols: Sequence[str], y: str, prediction: str, seasonality: int, date_col: str
) -> DataFrame:
    naive = F.lag(y, seasonality).over(series_window(group_cols, date_col))
    return df.withColumns({y: F.col(y).cast("double"), prediction: F.col(prediction).cast("double")}).withColumn(
        "_naive", naive
    )


def metrics_by_series(
    df: DataFrame,
    group_cols: Sequence[str],
    y: str = "y",
    prediction: str = "prediction",
    seasonality: int = 7,
    date_col: str = "date",
) -> DataFrame:
    """sMAPE, wMAPE and MASE per series; null where the scale is missing or not positive."""
    return (
        _with_naive(df, group_cols, y, prediction, seasonality, date_col)
        .groupBy(*group_cols)
        .agg(*_scale_free(y, prediction))
    )


def metrics_portfolio(
    df: DataFrame,
    group_cols: Sequence[str],
    y: str = "y",
    prediction: str = "prediction",
    seasonality: int = 7,
    date_col: str = "date",
    by: Sequence[str] = (),
) -> DataFrame:
    """The same over all series, or per value of ``by`` (then part of the series key)."""
    return (
        _with_naive(df, group_cols, y, prediction, seasonality, date_col)
        .groupBy(*by)
        .agg(*_scale_free(y, prediction))
        .withColumn("level", F.lit("portfolio"))
    )


def metrics_levels(
    df: DataFrame,
    group_cols: Sequence[str],
    levels: Sequence[Sequence[str]],
    y: str = "y",
    prediction: str = "prediction",
    seasonality: int = 7,
    date_col: str = "date",
) -> DataFrame:
    """The same figures at several levels from one pass; each level is a choice of ``group_cols``, none being the portfolio.

    Rows are summed up per series, where the window has put them already, and only these sums are
    grouped again, by all levels together. ``level`` names a row's columns, the others are null in it.
    """
    unknown = {c for level in levels for c in level} - set(group_cols)
    if unknown:
        raise ValueError(f"levels are made of the series key, not of {sorted(unknown)}")
    size = F.abs(F.col(y)) + F.abs(F.col(prediction))
    abs_err = F.abs(_error(y, prediction))
    smape = F.when(size > 0, abs_err / (size / 2)).when(size == 0, 0.0)
    scale = F.abs(F.col(y) - F.col("_naive"))
    sums = {"_smape": smape, "_error": abs_err, "_scale": scale}
    by_series = (
        _with_naive(df, group_cols, y, prediction, seasonality, date_col)
        .groupBy(*group_cols)
        .agg(
            F.sum(F.when(abs_err.isNotNull(), F.col(y))).alias("_actual"),
            *[f(c).alias(f"{n}_{f.__name__}") for n, c in sums.items() for f in (F.sum, F.count)],
        )
    )

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count"))

    # A bit of the grouping id is 1 where a column is left out, the first column's being the highest.
    ids = {sum((c not in level) << (len(group_cols) - 1 - i) for i, c in enumerate(group_cols)): level for level in levels}
    name = F.lit(None).cast("string")
    for number, level in ids.items():
        name = F.when(F.grouping_id() == number, F.lit(", ".join(level) or "portfolio")).otherwise(name)
    return by_series.groupingSets([[F.col(c) for c in level] for level in levels], *group_cols).agg(
        name.alias("level"),
        mean("_smape").alias("sMAPE"),
        ratio(F.sum("_error_sum"), F.sum("_actual")).alias("wMAPE"),
        ratio(mean("_error"), mean("_scale")).alias("MASE"),
    )


def metrics_long(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Numeric metrics as (metric, value) pairs; text columns are left to the side."""
    numeric = [c for c, kind in metrics.dtypes if kind in ("double", "float", "int", "bigint") and c not in keys]
    values = metrics.select(*keys, *[F.col(c).cast("double").alias(c) for c in numeric])
    return values.unpivot(list(keys), numeric, "metric", "value")


def wmape_spread(by_series: DataFrame, col: str = "family") -> DataFrame:
    """Least, greatest and approximate median wMAPE of the series of each family."""
    return by_series.groupBy(col).agg(
        F.min("wMAPE").alias("min_wMAPE"),
        F.max("wMAPE").alias("max_wMAPE"),
        F.percentile_approx("wMAPE", 0.5).alias("median_wMAPE"),
    )


# --- regression metrics -------------------------------------------------------------------------


def _regression(y: str, prediction: str) -> list[Column]:
    """All figures are over the rows that have both values."""
    err = _error(y, prediction)
    sse = F.sum(err * err)
    n = F.count(err)
    actual, predicted = (F.when(err.isNotNull(), F.col(c)) for c in (y, prediction))
    return [
        n.alias("sample_count"),
        F.avg(actual).alias("avg_actual"),
        F.avg(predicted).alias("avg_predicted"),
        F.try_divide(sse, n).alias("mse"),
        F.sqrt(F.try_divide(sse, n)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.try_divide(sse, n * F.var_pop(actual))).alias("r2"),
        (F.avg(F.abs(F.try_divide(err, F.col(y)))) * 100).alias("mape"),
    ]


def regression_metrics(
    df: DataFrame, by: Sequence[str] = (), y: str = "y", prediction: str = "prediction"
) -> DataFrame:
    """All error figures in one aggregation; rows with a zero actual are left out of MAPE.

    Predictions of several models stacked with their name and grouped by it give
    the model comparison.
    """
    return df.groupBy(*by).agg(*_regression(y, prediction))


def unpaired(df: DataFrame, by: Sequence[str] = (), y: str = "y", prediction: str = "prediction") -> DataFrame:
    """Rows that the error figures leave out, because the actual or the prediction is missing."""
    missing = _error(y, prediction).isNull()
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(missing).alias("unpaired_count")
    )


def worst_and_best(metrics: DataFrame, n: int, by: Sequence[str], measure: str = "rmse") -> DataFrame:
    """The ``n`` groups with the highest and the ``n`` with the lowest error."""
    worst = metrics.orderBy(F.desc(measure), *by).limit(n).withColumn("side", F.lit("worst"))
    best = metrics.orderBy(F.asc(measure), *by).limit(n).withColumn("side", F.lit("best"))
    return worst.unionByName(best)


def rmsle(df: DataFrame, by: Sequence[str] = (), y: str = "y", prediction: str = "prediction") -> DataFrame:
    """Root mean squared log error; values below 0 count as 0."""
    floor = [F.when(F.col(c) < 0, 0.0).otherwise(F.col(c)) for c in (prediction, y)]
    diff = F.log1p(floor[0]) - F.log1p(floor[1])
    return df.groupBy(*by).agg(F.sqrt(F.avg(diff * diff)).alias("rmsle"))


def split_metrics(df: DataFrame, by: Sequence[str] = (), y: str = "y", prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and guarded MAPE per split, side by side as ``<split>_<metric>``."""
    err = _error(y, prediction)
    metrics = {
        "rmse": F.sqrt(F.avg(err * err)),
        "mae": F.avg(F.abs(err)),
        "mape": F.avg(F.abs(guarded_pct_error(F.col(y), F.col(prediction)))),
    }
    return (
        df.groupBy(*by)
        .pivot("split", ["train", "validation", "test"])
        .agg(*[expr.alias(name) for name, expr in metrics.items()])
    )


def overfit_flag(metrics: DataFrame) -> DataFrame:
    """Whether the training error is far below the validation error."""
    return metrics.withColumn(
        "possible_overfit", F.col("train_rmse") < F.col("validation_rmse") * OVERFIT_RATIO
    )


def best_model(metrics: DataFrame, name: str = "model_name", measure: str = "rmse") -> DataFrame:
    """The model with the smallest stored error, ties by name."""
    best = F.min(F.struct(measure, name))
    return metrics.agg(best.alias("_best")).select(f"_best.{name}", f"_best.{measure}")


def fleet_summary(metrics: DataFrame, name: str) -> DataFrame:
    """Mean, median, best and worst R2 over per-family models."""
    return metrics.agg(
        F.count(F.lit(1)).alias("models"),
        F.avg("rmse").alias("avg_rmse"),
        F.avg("mae").alias("avg_mae"),
        F.avg("r2").alias("avg_r2"),
        F.median("r2").alias("median_r2"),
        F.max("r2").alias("best_r2"),
        F.max_by(name, "r2").alias(f"best_{name}"),
        F.min("r2").alias("worst_r2"),
        F.min_by(name, "r2").alias(f"worst_{name}"),
    )


def prediction_range(df: DataFrame, by: Sequence[str] = (), prediction: str = "prediction") -> DataFrame:
    """Extremes and spread of the predictions."""
    return df.groupBy(*by).agg(
        F.min(prediction).alias("min_pred"),
        F.max(prediction).alias("max_pred"),
        F.avg(prediction).alias("avg_pred"),
        F.stddev_samp(prediction).alias("std_pred"),
    )


def residuals(df: DataFrame, y: str = "sales", prediction: str = "predicted_sales") -> DataFrame:
    """Validation rows with their residual."""
    return df.withColumn("residual", _error(y, prediction))


# --- error analysis -----------------------------------------------------------------------------


def actual_vs_predicted(
    df: DataFrame, by: Sequence[Column | str], y: str = "sales", prediction: str = "predicted_sales"
) -> DataFrame:
    """Totals of actuals and predictions with their difference."""
    return (
        df.groupBy(*by)
        .agg(F.sum(y).alias("actual"), F.sum(prediction).alias("predicted"))
        .withColumn("residual", F.col("actual") - F.col("predicted"))
    )


def weekly_actual_vs_predicted(df: DataFrame, date_col: str = "date", **columns: str) -> DataFrame:
    """The same per week, labelled by its Monday."""
    return actual_vs_predicted(df, [week_start(date_col).alias("week")], **columns)


def top_groups_daily(
    df: DataFrame, group: str, n: int = 6, y: str = "sales", prediction: str = "predicted_sales", date_col: str = "date"
) -> DataFrame:
    """Daily totals of the ``n`` groups that sold most."""
    top = df.groupBy(group).agg(F.sum(y).alias("_total")).orderBy(F.desc("_total"), group).limit(n).select(group)
    return actual_vs_predicted(df.join(F.broadcast(top), group, "left_semi"), [group, date_col], y, prediction)


def error_by_date(
    df: DataFrame, date_col: str = "date", y: str = "y", prediction: str = "prediction"
) -> DataFrame:
    """Error of the daily totals per split."""
    totals = df.groupBy(date_col, "split").agg(F.sum(y).alias(y), F.sum(prediction).alias(prediction))
    err = _error(y, prediction)
    return totals.withColumns(
        {
            "error": err,
            "abs_error": F.abs(err),
            "pct_error": guarded_pct_error(F.col(y), F.col(prediction)),
        }
    )


def split_summary(df: DataFrame, y: str = "y", prediction: str = "prediction") -> DataFrame:
    """Mean, deviation and extremes of actuals and predictions per split."""
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        *[fn(c).alias(f"{c}_{name}") for c in (y, prediction) for name, fn in stats.items()],
    )


def forecast_errors(df: DataFrame, y: str = "y", prediction: str = "prediction", date_col: str = "date") -> DataFrame:
    """Error, absolute and percent error of every row with Monday-based calendar columns."""
    err = _error(y, prediction)
    return df.withColumns(
        {
            "error": err,
            "abs_error": F.abs(err),
            "pct_error": pct_error(F.col(y), F.col(prediction)),
            **iso_calendar(date_col),
        }
    )


def prediction_sample(
    df: DataFrame, order: Sequence[str], n: int = 1000, y: str = "y", prediction: str = "prediction"
) -> DataFrame:
    """The first rows with how far the prediction lies above the actual, and the size of that in percent."""
    over = F.col(prediction) - F.col(y)
    return (
        df.withColumns(
            {
                "error": over,
                "abs_error": F.abs(over),
                "pct_error": F.abs(F.try_divide(over, F.col(y))) * 100,
            }
        )
        .orderBy(*order)
        .limit(n)
    )


def family_daily(df: DataFrame, y: str = "y", prediction: str = "prediction") -> DataFrame:
    """Totals per family and day over all stores."""
    return df.groupBy("family", "date").agg(F.sum(y).alias(y), F.sum(prediction).alias(prediction))


def error_summary(errors: DataFrame) -> DataFrame:
    """Mean error, MAE, mean percent error and RMSE of all rows."""
    return errors.agg(
        F.avg("error").alias("mean_error"),
        F.avg("abs_error").alias("mae"),
        F.avg("pct_error").alias("mean_pct_error"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
    )


def family_error_summary(errors: DataFrame, digits: int = 2) -> DataFrame:
    """Mean errors per family."""
    return errors.groupBy("family").agg(
        *[F.round(F.avg(c), digits).alias(c) for c in ("error", "abs_error", "pct_error")]
    )


def family_groups(errors: DataFrame, measure: str = "abs_error") -> DataFrame:
    """Families sorted into low and high error by the mean over all rows."""
    families = errors.groupBy("family").agg(
        F.avg(measure).alias(measure), F.sum(measure).alias("_sum"), F.count(measure).alias("_count")
    )
    everything = Window.partitionBy()  # over one row per family
    overall = F.sum("_sum").over(everything) / F.sum("_count").over(everything)
    group = F.when(F.col(measure) <= overall, "low_error").otherwise("high_error")
    return families.withColumn("family_group", group).drop("_sum", "_count")


# --- distributions ------------------------------------------------------------------------------


def crosstab_pct(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Share in percent of each column value within a row value."""
    counts = df.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1))).fillna(0)
    names = [str(v) for v in values]
    total = sum((F.col(f"`{v}`") for v in names[1:]), F.col(f"`{names[0]}`"))
    return counts.select(row, *[(F.col(f"`{v}`") / total * 100).alias(v) for v in names])


def topk_values(df: DataFrame, group: str, col: str, k: int) -> DataFrame:
    """The ``k`` most frequent values of a column in each group, ties by value."""
    counts = df.groupBy(group, col).agg(F.count(F.lit(1)).alias("row_count"))
    w = Window.partitionBy(group).orderBy(F.desc("row_count"), col)
    return counts.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)


def most_frequent(df: DataFrame, group: str, col: str) -> DataFrame:
    """The mode of a column in each group, the first by value among equals."""
    return topk_values(df, group, col, 1).select(group, F.col(col).alias(f"top_{col}"))


def model_pivot(metrics: DataFrame, row: str, name: str, models: Sequence[str], measure: str = "r2") -> DataFrame:
    """One row per family, one column per model."""
    return metrics.groupBy(row).pivot(name, list(models)).agg(F.round(F.avg(measure), 2))


def model_melt(wide: DataFrame, row: str, models: Sequence[str], name: str = "period", measure: str = "r2") -> DataFrame:
    """Back to one row per family and model."""
    return wide.unpivot(row, list(models), name, measure)
