"""Cleaning, de-duplication, calendars and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandflow.functions.calendar import date_bounds
from demandflow.session import dimension_join

MANDATORY_TRAIN = ("id", "date", "store_nbr", "family", "sales", "onpromotion")
MANDATORY_TEST = ("id", "date", "store_nbr", "family", "onpromotion")


def keep_first(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by all remaining columns, so always the same one.

    The top-1 filter is applied before the shuffle too, so a key holding a large
    share of all rows sends one row per task.
    """
    order = [c for c in df.columns if c not in key]
    w = Window.partitionBy(*key).orderBy(*(order or key))
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def _clean(df: DataFrame, mandatory: Sequence[str]) -> DataFrame:
    typed = {"date": F.to_date("date"), "onpromotion": F.col("onpromotion").cast("int")}
    if "sales" in mandatory:
        typed["sales"] = F.col("sales").cast("double")
    return keep_first(df.dropna(subset=list(mandatory)).withColumns(typed), ["id"])


def clean_sales(df: DataFrame) -> DataFrame:
    """Training rows with every mandatory column, typed, one per id."""
    return _clean(df.select(*MANDATORY_TRAIN), MANDATORY_TRAIN)


def clean_future(df: DataFrame) -> DataFrame:
    """Rows to forecast with every mandatory column, typed, one per id."""
    return _clean(df.select(*MANDATORY_TEST), MANDATORY_TEST)


def clean_stores(df: DataFrame) -> DataFrame:
    """Stores with a number and a city, one per number."""
    return keep_first(
        df.select("store_nbr", "city", "state", "type", "cluster").dropna(subset=["store_nbr"]), ["store_nbr"]
    )


def fill_gaps(
    df: DataFrame,
    date_col: str,
    value_col: str,
    series_cols: Sequence[str] = (),
    until: DataFrame | None = None,
) -> DataFrame:
    """A daily series without gaps: last known value, else (at the start) the first known one.

    Every known value is repeated until the day before the next one, and the
    first also back to the first listed day, so one shuffle by series is all it
    takes. Of several known values of a date the largest is taken. A window
    partition holds the rows of a series, which are the days of the calendar
    and their repeats. ``until`` (one row, one date) extends a series beyond its own end.
    """
    keys = list(series_cols)
    rows = df.select(*keys, F.to_date(date_col).alias(date_col), F.col(value_col).cast("double").alias(value_col))
    whole = Window.partitionBy(*keys)
    known = rows.withColumns({"_first": F.min(date_col).over(whole), "_last": F.max(date_col).over(whole)}).dropna(
        subset=[value_col]
    )
    if until is not None:
        known = known.withColumn("_last", F.greatest("_last", until.scalar()))
    in_order = whole.orderBy(date_col, value_col)
    start = F.when(F.rank().over(whole.orderBy(date_col)) == 1, F.col("_first")).otherwise(F.col(date_col))
    following = F.lead(date_col).over(in_order)
    end = F.coalesce(F.date_sub(following, 1), "_last")
    last_of_day = following.isNull() | (following > F.col(date_col))
    spans = known.withColumns({"_start": start, "_end": end, "_last_of_day": last_of_day}).where("_last_of_day")
    return spans.select(
        *keys, F.explode(F.sequence("_start", "_end", F.expr("interval 1 day"))).alias(date_col), value_col
    )


def holiday_calendar(
    holidays: DataFrame,
    stores: DataFrame,
    national: str,
    spine: DataFrame | None = None,
    match_city: bool = False,
) -> DataFrame:
    """One row per calendar day and state with ``is_holiday`` 0/1.

    Transferred holidays are not observed. A national holiday covers every state;
    any other one covers the state in ``locale_name`` or, with ``match_city``,
    the state of the city named there. ``spine`` sets the first and last day,
    by default those of the listed holidays.
    """
    bounds = date_bounds(holidays if spine is None else spine)
    first, last = (bounds.select(c).scalar() for c in ("first_date", "last_date"))
    observed = holidays.filter(~F.col("transferred")).select("date", "locale_name")
    states = stores.select("state").distinct()
    places = states.select("state", F.lit(national).alias("locale_name")).unionByName(
        states.select("state", F.col("state").alias("locale_name"))
    )
    if match_city:
        places = places.unionByName(stores.select("state", F.col("city").alias("locale_name")).distinct())
    # At most two places per state and one per city: no more than three per store.
    marked = dimension_join(observed, places, "locale_name", "inner", bound=stores).filter(
        F.col("date").between(first, last)
    )
    days = F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date")
    return (
        states.select(days, "state", F.lit(0).alias("is_holiday"))
        .unionByName(marked.select("date", "state", F.lit(1).alias("is_holiday")))
        .groupBy("date", "state")
        .agg(F.max("is_holiday").alias("is_holiday"))
    )


def holiday_wide(calendar: DataFrame, states: Sequence[str]) -> DataFrame:
    """The holiday calendar with one column per state."""
    return calendar.groupBy("date").pivot("state", list(states)).agg(F.max("is_holiday"))


def reconcile(before: DataFrame, after: DataFrame, measure: str = "sales") -> DataFrame:
    """Row count and total of a measure before and after a transformation."""

    def totals(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(
            F.lit(stage).alias("stage"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col(measure).cast("double")).alias("total"),
        )

    return totals(before, "before").unionByName(totals(after, "after"))
