"""Time-based splits and eligibility gates.

Each split adds columns to the rows instead of returning several frames, so one
pass serves all parts; ``part`` picks one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.operators.features import series_window
from demandflow.session import dimension_join, materialize

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def part(df: DataFrame, name: str) -> DataFrame:
    """The rows of one part of a split."""
    return df.filter(F.col("split") == name).drop("split")


def with_min_history(df: DataFrame, group_cols: Sequence[str], min_rows: int) -> DataFrame:
    """Rows of series that have at least ``min_rows`` rows."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*group_cols))
    return df.withColumn("_n", n).filter(F.col("_n") >= min_rows).drop("_n")


def split_by_date(df: DataFrame, train_end: str, date_col: str = "date") -> DataFrame:
    """Training up to and including a date, test after it."""
    return df.withColumn("split", F.when(F.col(date_col) <= F.lit(train_end).cast("date"), TRAIN).otherwise(TEST))


def split_horizon(
    df: DataFrame, group_cols: Sequence[str], horizon: int, min_train: int, date_col: str = "date"
) -> DataFrame:
    """The last ``horizon`` rows of each series are the test; short series go."""
    w = Window.partitionBy(*group_cols)
    return (
        df.withColumns(
            {
                "_row": F.row_number().over(series_window(group_cols, date_col)),
                "_n": F.count(F.lit(1)).over(w),
            }
        )
        .filter(F.col("_n") >= min_train + horizon)
        .withColumn("split", F.when(F.col("_row") > F.col("_n") - horizon, TEST).otherwise(TRAIN))
        .drop("_row", "_n")
    )


def _last_day(df: DataFrame, date_col: str, last: DataFrame | None) -> Column:
    """The last date of ``df``, from the one-row frame ``last`` where the caller has it at less cost."""
    return (df.agg(F.max(date_col)) if last is None else last).scalar()


def split_train_val_test(
    df: DataFrame, test_days: int, val_days: int, date_col: str = "date", last: DataFrame | None = None
) -> DataFrame:
    """Three parts by calendar horizons counted back from the last day."""
    test_start = F.date_sub(_last_day(df, date_col, last), test_days - 1)
    val_start = F.date_sub(test_start, val_days)
    return df.withColumn(
        "split",
        F.when(F.col(date_col) >= test_start, TEST).when(F.col(date_col) >= val_start, VALIDATION).otherwise(TRAIN),
    )


def split_shares(split: DataFrame) -> DataFrame:
    """Rows, share of all rows and date range of each part."""
    counts = split.groupBy("split").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("date").alias("min_date"), F.max("date").alias("max_date")
    )
    total = F.sum("row_count").over(Window.partitionBy())  # over one row per part
    return counts.withColumn("share_pct", F.col("row_count") / total * 100)


def short_groups(split: DataFrame, group_cols: Sequence[str], min_train: int) -> DataFrame:
    """Groups with fewer training rows than required, including those with none."""
    return (
        split.groupBy(*group_cols)
        .agg(F.count_if(F.col("split") == TRAIN).alias("train_rows"))
        .filter(F.col("train_rows") < min_train)
    )


def split_last_days(
    df: DataFrame, days: int = 28, date_col: str = "date", last: DataFrame | None = None
) -> DataFrame:
    """The last ``days`` days are for validation."""
    cut = F.date_sub(_last_day(df, date_col, last), days)
    return df.withColumn("split", F.when(F.col(date_col) > cut, VALIDATION).otherwise(TRAIN))


def _fraction_cut(fraction: float, first: Column, last: Column) -> Column:
    return F.date_add(first, F.floor(F.datediff(last, first) * F.lit(fraction)).cast("int"))


def split_fraction(
    df: DataFrame, group_cols: Sequence[str], fraction: float = 0.8, date_col: str = "date"
) -> DataFrame:
    """Each group is cut at a fraction of its own date span.

    A group here may be a whole product family, of which there are few but with
    very many rows: its bounds are aggregated, written and joined back, which
    leaves the rows where they are.
    """
    bounds = df.groupBy(*group_cols).agg(F.min(date_col).alias("_first"), F.max(date_col).alias("_last"))
    cut = _fraction_cut(fraction, F.col("_first"), F.col("_last"))
    cuts = bounds.select(*group_cols, cut.alias("split_date"))
    dated = dimension_join(df, materialize(cuts, "split_dates"), group_cols, "inner")
    return dated.withColumn("split", F.when(F.col(date_col) < F.col("split_date"), TRAIN).otherwise(TEST))


def training_eligibility(
    df: DataFrame,
    group_cols: Sequence[str],
    feature_cols: Sequence[str],
    min_rows: int = 1000,
    min_train: int = 100,
    min_test: int = 20,
    fraction: float = 0.8,
    date_col: str = "date",
    target_col: str = "sales",
) -> DataFrame:
    """Per group its row counts and why it is skipped, or ``eligible``.

    Rows are reduced to counts per group and day before the cut date is applied.
    """
    clean = F.lit(True)
    for c in (target_col, *feature_cols):
        clean = clean & F.col(c).isNotNull()
    daily = df.groupBy(*group_cols, date_col).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(clean).alias("clean")
    )
    w = Window.partitionBy(*group_cols)
    cut = _fraction_cut(fraction, F.min(date_col).over(w), F.max(date_col).over(w))
    counts = (
        daily.withColumn("_cut", cut)
        .groupBy(*group_cols)
        .agg(
            F.sum("rows").alias("row_count"),
            F.sum("clean").alias("clean_rows"),
            F.sum(F.when(F.col(date_col) < F.col("_cut"), F.col("clean")).otherwise(0)).alias("train_rows"),
            F.sum(F.when(F.col(date_col) >= F.col("_cut"), F.col("clean")).otherwise(0)).alias("test_rows"),
        )
    )
    return counts.withColumn(
        "reason",
        F.when(F.col("row_count") < min_rows, "insufficient_data")
        .when(F.col("clean_rows") < min_rows, "too_many_nulls")
        .when((F.col("train_rows") < min_train) | (F.col("test_rows") < min_test), "insufficient_split")
        .otherwise("eligible"),
    )
