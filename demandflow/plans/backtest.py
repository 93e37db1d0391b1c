"""Rolling-origin evaluation.

Fold ``k`` tests the ``horizon`` observations that end ``k * step`` observations
before the end of the series and may train on everything older. Features are
computed once on the whole history from strictly earlier rows, so no fold sees
its own test values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.operators.features import series_window
from demandflow.operators.metrics import metrics_portfolio


def _from_end(group_cols: Sequence[str], date_col: str) -> Column:
    """0 for the last observation of a series, 1 for the one before, ..."""
    size = F.count(F.lit(1)).over(Window.partitionBy(*group_cols))
    return (size - F.row_number().over(series_window(group_cols, date_col))).cast("int")


def backtest_folds(
    df: DataFrame, group_cols: Sequence[str], folds: int, horizon: int, step: int, date_col: str = "date"
) -> DataFrame:
    """Per series and fold the cutoff row, the last training day and the rows on either side."""
    indexed = df.select(*group_cols, date_col, _from_end(group_cols, date_col).alias("_back"))
    # The last training row of fold k has position horizon + k * step from the end.
    fold = (F.col("_back") - horizon) / F.lit(step)
    cutoffs = indexed.filter(
        (F.col("_back") >= horizon) & ((F.col("_back") - horizon) % step == 0) & (fold < folds)
    ).withColumn("fold", fold.cast("int"))
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_rows"))
    return cutoffs.join(sizes, list(group_cols)).select(
        *group_cols,
        "fold",
        (F.col("_rows") - F.col("_back")).cast("bigint").alias("train_rows"),
        F.lit(horizon).cast("bigint").alias("test_rows"),
        F.col(date_col).alias("cutoff_date"),
    )


def with_test_folds(
    df: DataFrame, group_cols: Sequence[str], folds: int, horizon: int, step: int, date_col: str = "date"
) -> DataFrame:
    """Rows that some fold tests, once per such fold, with ``fold`` and the ``step_ahead`` (1 = next after the cutoff).

    A row belongs to at most ``ceil(horizon / step)`` folds; only these copies are made.
    """
    back = F.col("_back")
    first = F.greatest(F.lit(0), F.floor((back - horizon) / F.lit(step)) + 1)
    last = F.least(F.lit(folds - 1), F.floor(back / F.lit(step)))
    tested = F.when(first <= last, F.sequence(first, last))
    return (
        df.withColumn("_back", _from_end(group_cols, date_col))
        .filter(back < (folds - 1) * step + horizon)
        .withColumn("fold", F.explode(tested))
        .withColumn("fold", F.col("fold").cast("int"))
        .withColumn("step_ahead", (F.lit(horizon) - (back - F.col("fold") * step)).cast("int"))
        .drop("_back")
    )


def train_rows(
    df: DataFrame, group_cols: Sequence[str], fold: int, horizon: int, step: int, date_col: str = "date"
) -> DataFrame:
    """Rows fold ``fold`` may train on."""
    back = _from_end(group_cols, date_col)
    return df.withColumn("_back", back).filter(F.col("_back") >= horizon + fold * step).drop("_back")


def naive_backtest(
    df: DataFrame,
    group_cols: Sequence[str],
    folds: int,
    horizon: int,
    step: int,
    seasonality: int = 7,
    date_col: str = "date",
    target_col: str = "sales",
) -> DataFrame:
    """Seasonal-naive predictions of every fold, repeating the last season known at the cutoff."""
    w = series_window(group_cols, date_col)
    seasons = -(-horizon // seasonality)
    known = F.array(*[F.lag(target_col, seasonality * (i + 1)).over(w) for i in range(seasons)])
    rows = df.select(*group_cols, date_col, F.col(target_col).alias("y"), known.alias("_known"))
    tested = with_test_folds(rows, group_cols, folds, horizon, step, date_col)
    season = F.floor((F.col("step_ahead") - 1) / F.lit(seasonality)).cast("int")
    return tested.withColumn("prediction", F.col("_known")[season]).drop("_known").filter(
        F.col("prediction").isNotNull()
    )


def backtest_metrics(predictions: DataFrame, group_cols: Sequence[str], seasonality: int = 7) -> DataFrame:
    """Portfolio metrics per fold."""
    return metrics_portfolio(predictions, [*group_cols, "fold"], seasonality=seasonality, by=["fold"])
