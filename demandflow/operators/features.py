"""Granularity, lag and rolling features of daily series.

Frames count rows, not days: over a series with missing days a lag of 7 is the
seventh observation back. ``densify`` adds the missing days first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.functions.calendar import series_calendar
from demandflow.operators.quality import assert_unique

# Fixed names of the aggregates a run may ask for.
AGGREGATES = {"sum": F.sum, "mean": F.avg, "avg": F.avg, "max": F.max, "min": F.min}


def _aggregate(how: str, column: str) -> Column:
    if how.lower() not in AGGREGATES:
        raise ValueError(f"unknown aggregate {how!r} for {column!r}")
    return AGGREGATES[how.lower()](column).alias(column)


def series_window(group_cols: Sequence[str], date_col: str = "date") -> WindowSpec:
    return Window.partitionBy(*group_cols).orderBy(date_col)


def aggregate_to_granularity(
    df: DataFrame,
    date_col: str,
    target_col: str,
    group_cols: Sequence[str],
    agg: str = "sum",
    extra_aggs: Mapping[str, str] | None = None,
) -> DataFrame:
    """D3: one row per group and day, the target and any extra columns aggregated as named."""
    wanted = {target_col: agg, **(extra_aggs or {})}
    return df.groupBy(*group_cols, F.to_date(date_col).alias(date_col)).agg(
        *[_aggregate(how, column) for column, how in wanted.items()]
    )


def densify(
    df: DataFrame, date_col: str, group_cols: Sequence[str], fill: Mapping[str, float] | None = None
) -> DataFrame:
    """Add the missing days between the first and last day of every series.

    Each row also stands for the days up to the next row; there its values are
    replaced by null or the given fill.
    """
    following = F.lead(date_col).over(series_window(group_cols, date_col))
    last_missing = F.coalesce(F.date_sub(following, 1), F.col(date_col))
    days = df.withColumn("_until", last_missing).withColumn(
        "_day", F.explode(F.sequence(date_col, "_until", F.expr("interval 1 day")))
    )
    values = [c for c in df.columns if c not in (*group_cols, date_col)]
    return days.select(
        *group_cols,
        F.col("_day").alias(date_col),
        *[F.when(F.col("_day") == F.col(date_col), F.col(c)).alias(c) for c in values],
    ).fillna(dict(fill or {}))


def lag_columns(target_col: str, w: WindowSpec, lags: Sequence[int], prefix: str = "lag_") -> dict[str, Column]:
    """E1."""
    return {f"{prefix}{n}": F.lag(target_col, n).over(w) for n in lags}


def moving_average_columns(
    target_col: str, w: WindowSpec, spans: Sequence[int], include_current: bool = False, prefix: str = "ma_"
) -> dict[str, Column]:
    """Means over the ``n`` rows before the current one, or ending with it.

    Including the current row lets a feature see the value it should predict.
    """
    shift = 0 if include_current else 1
    return {f"{prefix}{n}": F.avg(target_col).over(w.rowsBetween(1 - n - shift, -shift)) for n in spans}


def rolling_stats(
    df: DataFrame,
    group_cols: Sequence[str],
    date_col: str = "date",
    target_col: str = "sales",
    promo_col: str = "onpromotion",
) -> DataFrame:
    """The lag and trailing statistics of the tree-model experiments."""
    w = series_window(group_cols, date_col)
    last7 = w.rowsBetween(-7, -1)
    return df.withColumns(
        {
            **lag_columns(target_col, w, (7, 14, 30), f"{target_col}_lag_"),
            **moving_average_columns(target_col, w, (7, 14), prefix=f"{target_col}_rolling_mean_"),
            f"{target_col}_rolling_std_7": F.stddev_samp(target_col).over(last7),
            "promo_rolling_sum_7": F.sum(promo_col).over(last7),
        }
    )


def build_features(
    df: DataFrame,
    date_col: str,
    target_col: str,
    group_cols: Sequence[str],
    lags: Sequence[int] = (),
    spans: Sequence[int] = (),
    time_signals: bool = True,
    pre_aggregate: bool = True,
    target_agg: str = "sum",
    extra_aggs: Mapping[str, str] | None = None,
    include_current: bool = False,
    check_unique: bool = False,
) -> DataFrame:
    """Lags, moving averages and calendar signals; the first rows of a series, lacking history, go.

    Pre-aggregation makes (group, day) unique. Frames passed in already
    aggregated can be checked for that with ``check_unique``.
    """
    if pre_aggregate:
        df = aggregate_to_granularity(df, date_col, target_col, group_cols, target_agg, extra_aggs)
    elif check_unique:
        assert_unique(df, [*group_cols, date_col])
    w = series_window(group_cols, date_col)
    warmup = max([0, *lags, *spans])
    df = df.withColumns(
        {
            **lag_columns(target_col, w, lags),
            **moving_average_columns(target_col, w, spans, include_current),
            "_row": F.row_number().over(w),
        }
    ).filter(F.col("_row") > warmup)
    return df.drop("_row").withColumns(dict(series_calendar(date_col)) if time_signals else {})


def active_period(
    df: DataFrame, group_cols: Sequence[str], date_col: str = "date", target_col: str = "sales"
) -> DataFrame:
    """Rows from the first day with a positive sale on; series without one go."""
    start = F.min(F.when(F.col(target_col) > 0, F.col(date_col))).over(Window.partitionBy(*group_cols))
    return df.withColumn("active_start_date", start).filter(F.col(date_col) >= F.col("active_start_date"))


def stable_period(
    df: DataFrame,
    group_cols: Sequence[str],
    date_col: str = "date",
    target_col: str = "sales",
    span: int = 14,
    needed: int = 7,
) -> DataFrame:
    """Rows from the first day on which ``needed`` of the last ``span`` rows had a positive sale."""
    w = series_window(group_cols, date_col)
    positive = F.count_if(F.col(target_col) > 0).over(w.rowsBetween(1 - span, 0))
    start = F.min(F.when(F.col("_positive") >= needed, F.col(date_col))).over(Window.partitionBy(*group_cols))
    return (
        df.withColumn("_positive", positive)
        .withColumn("stable_start_date", start)
        .filter(F.col(date_col) >= F.col("stable_start_date"))
        .drop("_positive")
    )


def sufficient_series(
    df: DataFrame,
    group_cols: Sequence[str],
    min_days: int,
    date_col: str = "date",
    target_col: str = "sales",
    min_total: float = 0.0,
) -> DataFrame:
    """Series with enough distinct days and total sales."""
    return (
        df.groupBy(*group_cols)
        .agg(F.count_distinct(date_col).alias("days_count"), F.sum(target_col).alias("total_sales"))
        .filter((F.col("days_count") >= min_days) & (F.col("total_sales") >= min_total))
    )


def trainable_series(
    df: DataFrame, group_cols: Sequence[str], min_days: int = 365, date_col: str = "date", target_col: str = "sales"
) -> DataFrame:
    """Rows of the series that qualify for training.

    The distinct days are counted in date order within the series, so that one
    shuffle serves the test and the result.
    """
    whole = Window.partitionBy(*group_cols)
    new_day = F.coalesce(F.col(date_col) != F.lag(date_col).over(series_window(group_cols, date_col)), F.lit(True))
    return (
        df.withColumn("_new_day", new_day)
        .withColumns({"_days": F.count_if("_new_day").over(whole), "_total": F.sum(target_col).over(whole)})
        .filter((F.col("_days") >= min_days) & (F.col("_total") >= 0))
        .drop("_new_day", "_days", "_total")
    )


def hash_sample(df: DataFrame, fraction: float, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Bernoulli sample that depends on the key only, not on how rows are partitioned."""
    buckets = 1_000_000
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(buckets)) < int(fraction * buckets))


def numeric_features(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Numeric columns that are not keys, date or target."""
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def existing(columns: Sequence[str], df: DataFrame) -> list[str]:
    """Those of ``columns`` that ``df`` has, in order."""
    return [c for c in columns if c in df.columns]
