"""Predictors that need no fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.operators.features import lag_columns, moving_average_columns, series_window


def seasonal_naive(
    df: DataFrame,
    group_cols: Sequence[str],
    seasons: Sequence[int] = (7,),
    spans: Sequence[int] = (),
    date_col: str = "date",
    target_col: str = "sales",
) -> DataFrame:
    """One row per observation and baseline: ``naive_<m>`` (m rows back) or ``ma_<n>`` (mean of n rows back).

    All baselines come from one sort of each series.
    """
    w = series_window(group_cols, date_col)
    candidates = {
        **lag_columns(target_col, w, seasons, "naive_"),
        **moving_average_columns(target_col, w, spans),
    }
    wide = df.select(*group_cols, date_col, F.col(target_col).alias("y"), *[c.alias(n) for n, c in candidates.items()])
    return wide.unpivot(
        [*group_cols, date_col, "y"], list(candidates), "model_name", "prediction"
    ).filter(F.col("prediction").isNotNull())
