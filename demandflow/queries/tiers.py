"""Cleaning, calendars, enrichment, codes and the daily fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.functions import calendar as cal
from demandflow.functions import scalars
from demandflow.operators import clean, encode
from demandflow.operators.quality import daily_total
from demandflow.plans.publish import publish_tiers
from demandflow.queries import query
from demandflow.queries.common import RUN_AT, retail, rounded, tiers
from demandflow.session import materialize, new_dir
from demandflow.sources.retail import NATIONAL


@query
def gold_daily_fact(spark: SparkSession, folder: str) -> DataFrame:
    return tiers(spark, folder).gold


@query
def published_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Every table of every tier, written in order, with its row count."""
    tables = publish_tiers(retail(spark, folder), new_dir(spark, "lake"), RUN_AT)
    counts = [
        tables[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name in tables.names
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def gold_with_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return tiers(spark, folder).gold_with_transactions


@query
def enriched_training(spark: SparkSession, folder: str) -> DataFrame:
    return tiers(spark, folder).training


@query
def enriched_testing(spark: SparkSession, folder: str) -> DataFrame:
    return tiers(spark, folder).testing


@query
def clean_sales(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_sales(retail(spark, folder).sales_raw)


@query
def clean_future(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_future(retail(spark, folder).future_raw)


@query
def etl_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    raw = retail(spark, folder).sales_raw
    return clean.reconcile(raw, clean.clean_sales(raw))


@query
def date_spine(spark: SparkSession, folder: str) -> DataFrame:
    return cal.date_spine(retail(spark, folder).holidays_raw)


@query
def holiday_calendar(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    return clean.holiday_calendar(r.stored_holidays, r.stores, NATIONAL)


@query
def holiday_wide(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    stores = materialize(r.stores, "silver_stores")
    states = [row["state"] for row in stores.select("state").distinct().orderBy("state").collect()]
    return clean.holiday_wide(clean.holiday_calendar(r.stored_holidays, stores, NATIONAL), states)


@query
def oil_gap_fill(spark: SparkSession, folder: str) -> DataFrame:
    return clean.fill_gaps(retail(spark, folder).oil_raw, "date", "dcoilwtico")


@query
def normalize_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Spellings of a flag, derived from every order."""
    spelling = F.array(*[F.lit(s) for s in ("True", "true", "1", "False", "false", "0", "yes")])
    orders = retail(spark, folder).table("orders").select(
        "o_orderkey", spelling[(F.col("o_orderkey") % 7).cast("int")].alias("flag_text")
    )
    return orders.select("o_orderkey", "flag_text", scalars.normalize_flag(F.col("flag_text")).alias("flag"))


@query
def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    days = cal.date_spine(retail(spark, folder).sales)
    columns = {**cal.series_calendar(), **cal.season_flags(), "weekday": F.weekday("date")}
    return days.withColumns({**columns, "week_start": cal.week_start("date"), "week_end": cal.week_end("date")})


@query
def log_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    sales = retail(spark, folder).sales.select("date", "store_nbr", "family", "sales")
    logged = sales.withColumn("log_sales", F.log1p("sales"))
    return rounded(logged.withColumn("restored", scalars.from_log1p(F.col("log_sales"))), "log_sales", "restored")


@query
def category_codes(spark: SparkSession, folder: str) -> DataFrame:
    return tiers(spark, folder).codes


@query
def large_category_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Two columns of very different size, numbered the way dictionaries too large for a window are."""
    parts = retail(spark, folder).table("part")
    return encode.number_sorted(encode.category_values(parts, ["p_name", "p_type"]))


@query
def hashed_features(spark: SparkSession, folder: str) -> DataFrame:
    training = tiers(spark, folder).training
    return encode.hashed_features(training, ["family", "city", "state", "type"]).select(
        "date", "store_nbr", "family", F.col("hash_features").cast("string").alias("hash_features")
    )


@query
def daily_total_check(spark: SparkSession, folder: str) -> DataFrame:
    return daily_total(tiers(spark, folder).gold, "1998-08-05")


@query
def fact_preview(spark: SparkSession, folder: str) -> DataFrame:
    gold = tiers(spark, folder).gold
    wanted = gold.filter((F.col("sales") == 1) & F.col("is_holiday").isNotNull())
    return wanted.select("id", "date", "store_nbr", "family", "sales", "is_holiday").orderBy(
        "date", "store_nbr", "family", "id"
    ).limit(50)
