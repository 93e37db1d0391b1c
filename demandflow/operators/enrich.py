"""Enrichment joins and the daily gold fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.functions.calendar import gold_calendar, training_calendar
from demandflow.functions.scalars import normalize_flag
from demandflow.operators.encode import encode
from demandflow.session import dimension_join

CATEGORIES = ("family", "city", "state", "type")
FACT_KEY = ("id", "date", "store_nbr", "family")


def with_dimensions(fact: DataFrame, stores: DataFrame, holidays: DataFrame, oil: DataFrame) -> DataFrame:
    """Store attributes, holiday flag of the store's state, price of the day; misses stay null."""
    fact = dimension_join(fact, stores, "store_nbr")
    fact = dimension_join(fact, holidays, ["date", "state"])
    return dimension_join(fact, oil, "date")


def enrich(
    fact: DataFrame,
    stores: DataFrame,
    holidays: DataFrame,
    oil: DataFrame,
    codes: DataFrame | None = None,
) -> DataFrame:
    """Modelling table; rows without a store or a price are dropped.

    ``codes`` is the dictionary fitted on the training side, applied to training
    and testing rows alike.
    """
    joined = with_dimensions(fact, stores, holidays, oil).fillna({"is_holiday": 0}).dropna()
    if codes is not None:
        joined = encode(joined, codes, CATEGORIES)
    return joined.withColumns(dict(training_calendar()))


def gold_daily_fact(
    sales: DataFrame,
    stores: DataFrame,
    holidays: DataFrame,
    oil: DataFrame,
    transactions: DataFrame | None = None,
) -> DataFrame:
    """The daily fact with store, price, holiday and calendar columns.

    Holidays match on date and state, which keeps one row per fact key.
    """
    fact = with_dimensions(sales, stores, holidays, oil)
    extra = []
    if transactions is not None:
        fact = dimension_join(fact, transactions, ["date", "store_nbr"])
        extra = [F.col("transactions").cast("int").alias("transactions")]
    return fact.select(
        *FACT_KEY,
        F.col("sales").cast("double").alias("sales"),
        F.col("onpromotion").cast("int").alias("onpromotion"),
        *extra,
        F.col("dcoilwtico").cast("double").alias("dcoilwtico"),
        "city",
        "state",
        F.col("type").alias("store_type"),
        "cluster",
        normalize_flag(F.col("is_holiday")).alias("is_holiday"),
    ).withColumns(dict(gold_calendar()))
