"""Year-to-date growth marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.functions.calendar import week_end
from demandflow.operators.features import series_window

# Which record kinds make up each scenario.
SCENARIOS = {
    "1x_promos": ("Actual", "Forecast - current"),
    "2x_promos": ("Actual", "Forecast - onpromotion_2x"),
}


@dataclass(frozen=True)
class Period:
    """Months 1..month of a year and of the year before."""

    year: int
    month: int

    @property
    def years(self) -> tuple[int, int]:
        return self.year - 1, self.year

    @classmethod
    def of(cls, df: DataFrame, date_col: str = "date") -> Period:
        """The period that ends with the last date of ``df`` (a single value read back)."""
        last: date = df.agg(F.max(date_col)).first()[0]
        return cls(last.year, last.month)


def ytd_segments(stack: DataFrame, period: Period) -> DataFrame:
    """Sales per year, store, family, city and kind over the comparable months.

    The lower bound is a plain date comparison, so it reaches the table scan.
    """
    comparable = (F.col("date") >= F.lit(date(period.year - 1, 1, 1))) & (F.month("date") <= period.month)
    return (
        stack.filter(comparable)
        .groupBy(F.year("date").alias("year"), "store_nbr", "family", "city", "data_type")
        .agg(F.sum("actual_sales").alias("total_sales"))
    )


def scenario_totals(segments: DataFrame, scenarios: Mapping[str, Sequence[str]] = SCENARIOS) -> DataFrame:
    """Sales per scenario, each the sum of its kinds, in one pass over the segments."""
    member = F.array_compact(
        F.array(*[F.when(F.col("data_type").isin(*kinds), name) for name, kinds in scenarios.items()])
    )
    return (
        segments.select("year", "store_nbr", "family", "city", "total_sales", F.explode(member).alias("scenario"))
        .groupBy("year", "store_nbr", "family", "city", "scenario")
        .agg(F.sum("total_sales").alias("total_sales"))
    )


def growth_by(totals: DataFrame, dim: str, period: Period, agg: str = "mean") -> DataFrame:
    """Per scenario and city or family one column per year and their growth in percent.

    ``mean`` averages over the (store, family) totals, ``sum`` adds them up.
    """
    before, latest = (str(y) for y in period.years)
    measure = {"mean": F.avg, "sum": F.sum}[agg]("total_sales")
    wide = totals.groupBy("scenario", dim).pivot("year", list(period.years)).agg(measure)
    return wide.withColumn("ytd_growth", (F.try_divide(F.col(f"`{latest}`"), F.col(f"`{before}`")) - 1) * 100)


def growth_delta(growth: DataFrame, dim: str = "family", scenarios: Sequence[str] = tuple(SCENARIOS)) -> DataFrame:
    """Growth of both scenarios side by side and their difference, largest first."""
    base, changed = scenarios
    wide = growth.groupBy(dim).pivot("scenario", list(scenarios)).agg(F.avg("ytd_growth"))
    return wide.withColumn("diff", F.col(f"`{changed}`") - F.col(f"`{base}`")).orderBy(F.desc("diff"), dim)


def family_year_pivot(sales: DataFrame, years: Sequence[int]) -> DataFrame:
    """Sales per family, one column per year, largest latest year first."""
    by_year = sales.groupBy("family", F.year("date").alias("year")).agg(F.sum("sales").alias("sales"))
    wide = by_year.groupBy("family").pivot("year", list(years)).agg(F.sum("sales"))
    return wide.orderBy(F.desc(f"`{max(years)}`"), "family")


def rows_per_year(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows per year, most first."""
    counts = df.groupBy(F.year(date_col).alias("year")).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), "year")


def data_type_bounds(stack: DataFrame) -> DataFrame:
    """First and last day per record kind."""
    return stack.groupBy("data_type").agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def weekly_resample(df: DataFrame, group_cols: Sequence[str], date_col: str = "date", value_col: str = "sales") -> DataFrame:
    """Weekly totals labelled by the closing Sunday, empty weeks in between as 0."""
    weekly = df.groupBy(*group_cols, week_end(date_col).alias(date_col)).agg(F.sum(value_col).alias(value_col))
    following = F.lead(date_col).over(series_window(group_cols, date_col))
    until = F.coalesce(F.date_sub(following, 7), F.col(date_col))
    weeks = weekly.withColumn("_until", until).withColumn(
        "_week", F.explode(F.sequence(date_col, "_until", F.expr("interval 7 days")))
    )
    value = F.when(F.col("_week") == F.col(date_col), F.col(value_col)).otherwise(0.0)
    return weeks.select(*group_cols, F.col("_week").alias(date_col), value.alias(value_col))
