"""Calendar columns and date spines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the data model.
SALARY_DAYS = (15, 30)
MONTH_START_LAST_DAY = 5
MONTH_END_FIRST_DAY = 25
SPARK_WEEKEND = (1, 7)  # dayofweek: 1 = Sunday, 7 = Saturday
ISO_WEEKEND = (5, 6)  # weekday: 0 = Monday, 6 = Sunday


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def is_salary_day(date_col: str) -> Column:
    """H6."""
    return flag(F.dayofmonth(date_col).isin(*SALARY_DAYS))


def is_weekend(date_col: str) -> Column:
    """H3: Saturday or Sunday."""
    return flag(F.dayofweek(date_col).isin(*SPARK_WEEKEND))


def week_start(date_col: str) -> Column:
    """H8: the Monday of the week."""
    return F.date_sub(F.col(date_col), F.weekday(date_col))


def week_end(date_col: str) -> Column:
    """The Sunday that closes the week, the label of a weekly resample."""
    return F.date_add(week_start(date_col), 6)


def gold_calendar(date_col: str = "date") -> Mapping[str, Column]:
    """Columns of the daily gold fact."""
    return {
        "year": F.year(date_col),
        "month": F.month(date_col),
        "day": F.dayofmonth(date_col),
        "week_of_year": F.weekofyear(date_col),
        "day_of_week": F.dayofweek(date_col),
        "is_weekend": is_weekend(date_col),
    }


def training_calendar(date_col: str = "date") -> Mapping[str, Column]:
    """Columns of the enriched training and testing tables."""
    return {
        "day_of_week": F.dayofweek(date_col),
        "day_of_month": F.dayofmonth(date_col),
        "month": F.month(date_col),
        "year": F.year(date_col),
        "is_salary_day": is_salary_day(date_col),
    }


def series_calendar(date_col: str = "date") -> Mapping[str, Column]:
    """Columns added to a modelling series."""
    return {
        "dow": F.dayofweek(date_col),
        "dom": F.dayofmonth(date_col),
        "weekofyear": F.weekofyear(date_col),
        "month": F.month(date_col),
        "year": F.year(date_col),
        "is_salary_day": is_salary_day(date_col),
    }


def season_flags(date_col: str = "date") -> Mapping[str, Column]:
    """Columns of the tree-model experiments (H2, H5)."""
    day = F.dayofmonth(date_col)
    return {
        "week_of_year": F.weekofyear(date_col),
        "quarter": F.quarter(date_col),
        "is_weekend": is_weekend(date_col),
        "is_month_start": flag(day <= MONTH_START_LAST_DAY),
        "is_month_end": flag(day >= MONTH_END_FIRST_DAY),
    }


def iso_calendar(date_col: str = "date") -> Mapping[str, Column]:
    """Columns of the error analysis, Monday-based (H4)."""
    weekday = F.weekday(date_col)
    return {
        "day_of_week": weekday,
        "month": F.month(date_col),
        "day": F.dayofmonth(date_col),
        "week_of_year": F.weekofyear(date_col),
        "is_weekend": flag(weekday.isin(*ISO_WEEKEND)),
    }


def date_bounds(df: DataFrame, date_col: str = "date") -> DataFrame:
    """One row with ``first_date`` and ``last_date``."""
    return df.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


def date_spine(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Every calendar day between the first and the last date of ``df``."""
    days = F.sequence("first_date", "last_date", F.expr("interval 1 day"))
    return date_bounds(df, date_col).select(F.explode(days).alias(date_col))
