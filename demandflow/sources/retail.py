"""Retail-shaped tables derived by Spark from the generic test tables.

Every frame is at the grain its name says and is lazy. Daily frames hold at most
one row per series and day, which is what bounds every per-series window and
every per-series Python group in this package by the length of the calendar.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandflow.functions.calendar import flag
from demandflow.session import dimension_join, materialize, spread

# Fixed values of the derivation.
STORE_TYPES = ("A", "B", "C", "D", "E")
PROMOTION_DISCOUNT = 0.08
FAMILY_NULL_STRIDE = 89
SALES_NULL_STRIDE = 97
CLUSTERS = 17
NATIONAL = "ALL"
FORECAST_DAYS = 90
FUTURE_DAYS = 28
RETRAINED_DAYS = 120
PROMOTION_UPLIFT = 0.25


def _exact_mean(column: str) -> Column:
    """Mean of a two-decimal amount, independent of summation order."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))


class Retail:
    """The retail tables below one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A3, A4: one source table; its schema is looked up once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def stores(self) -> DataFrame:
        supplier, nation, region = (self.table(t) for t in ("supplier", "nation", "region"))
        nation = nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
        region = region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        located = dimension_join(dimension_join(supplier, nation, "s_nationkey", "inner"), region, "n_regionkey", "inner")
        kind = F.array(*[F.lit(t) for t in STORE_TYPES])[(F.col("s_suppkey") % len(STORE_TYPES)).cast("int")]
        return located.select(
            F.col("s_suppkey").alias("store_nbr"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            kind.alias("type"),
            (F.col("s_suppkey") % CLUSTERS).cast("int").alias("cluster"),
        )

    def at_stores(self, df: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
        """``df`` with columns of its store. There is one store per supplier, whose count is a footer read."""
        stores = self.stores.select("store_nbr", *columns)
        return dimension_join(df, stores, "store_nbr", how, bound=self.table("supplier"))

    @cached_property
    def stored_sales(self) -> DataFrame:
        """The daily fact as a written table, for jobs that read it several times."""
        return materialize(self.sales, "silver_sales")

    @cached_property
    def _sold(self) -> DataFrame:
        lineitem = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_quantity", "l_discount", "l_partkey"
        )
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        return dimension_join(lineitem, part, "l_partkey", "inner")

    @cached_property
    def sales(self) -> DataFrame:
        """Daily fact: one row per date, store and family.

        A store sells few items of a family a day, so summing them up before the shuffle saves little and takes a table
        of nearly all rows of a task: they are spread over tasks by their number instead.
        """
        items = self._dated(self._sold.withColumnRenamed("l_suppkey", "store_nbr"), "store_nbr")
        items = spread(items, self.table("lineitem").count(), "date", "family", "store_nbr")
        return self._daily(items, "store_nbr").select("date", "store_nbr", "family", "sales", "onpromotion")

    @staticmethod
    def _dated(sold: DataFrame, place: str) -> DataFrame:
        """The columns of sold items that ``_daily`` sums up."""
        day = F.col("l_shipdate").cast("date").alias("date")
        return sold.select(day, F.col("p_type").alias("family"), place, "l_quantity", "l_discount")

    @staticmethod
    def _daily(items: DataFrame, place: str) -> DataFrame:
        """Sold items per day, family and place."""
        return items.groupBy("date", "family", place).agg(
            F.sum(F.col("l_quantity").cast("bigint")).cast("double").alias("sales"),
            F.sum(flag(F.col("l_discount") >= PROMOTION_DISCOUNT)).cast("int").alias("onpromotion"),
        )

    @cached_property
    def sales_raw(self) -> DataFrame:
        """Uncleaned sales rows: ids repeat, families and sales are sometimes missing."""
        return self._sold.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_suppkey").alias("store_nbr"),
            F.when(F.col("l_partkey") % FAMILY_NULL_STRIDE != 0, F.col("p_type")).alias("family"),
            F.when(F.col("l_partkey") % SALES_NULL_STRIDE != 0, F.col("l_quantity")).alias("sales"),
            flag(F.col("l_discount") >= PROMOTION_DISCOUNT).alias("onpromotion"),
        )

    @cached_property
    def last_sale(self) -> DataFrame:
        """One row: the last day of sales."""
        return self.table("lineitem").agg(F.max(F.col("l_shipdate").cast("date")).alias("last_date"))

    def last_days(self, df: DataFrame, days: int) -> DataFrame:
        """Rows of ``df`` dated within the last ``days`` days of sales."""
        return df.filter(F.col("date") > F.date_sub(self.last_sale.scalar(), days))

    @cached_property
    def future(self) -> DataFrame:
        """Known promotions of the days to forecast; no sales column."""
        return self.last_days(self.sales.drop("sales"), FUTURE_DAYS)

    @cached_property
    def future_raw(self) -> DataFrame:
        """Uncleaned rows of the days to forecast; no sales column."""
        return self.last_days(self.sales_raw.drop("sales"), FUTURE_DAYS)

    @cached_property
    def transactions(self) -> DataFrame:
        """Orders per store and day. Pairs are made distinct first, so one huge order stays small in the join."""
        pairs = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey").distinct()
        orders = self.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
        return (
            pairs.join(orders, "o_orderkey")
            .groupBy("date", F.col("l_suppkey").alias("store_nbr"))
            .agg(F.count(F.lit(1)).cast("int").alias("transactions"))  # the pairs are distinct, the order key unique
        )

    @cached_property
    def stored_transactions(self) -> DataFrame:
        """``transactions`` as a written table, so that its size is known without computing it."""
        return materialize(self.transactions, "silver_transactions")

    @cached_property
    def oil_raw(self) -> DataFrame:
        """Daily price, weekdays only."""
        orders = self.table("orders").select(F.col("o_orderdate").cast("date").alias("date"), "o_totalprice")
        return orders.filter(F.weekday("date") < 5).groupBy("date").agg(_exact_mean("o_totalprice").alias("dcoilwtico"))

    @cached_property
    def holidays_raw(self) -> DataFrame:
        """National holidays on day 1, regional ones on day 15 of quarter-end months."""
        day, month = F.dayofmonth("date"), F.month("date")
        regional = (day == 15) & month.isin(3, 6, 9, 12)
        dates = (
            self.table("orders")
            .select(F.col("o_orderdate").cast("date").alias("date"))
            .filter((day == 1) | regional)
            .distinct()
            .withColumn("r_regionkey", F.when(regional, month % 5))
        )
        region = self.table("region").select("r_name", "r_regionkey")
        return (
            dimension_join(dates, region, "r_regionkey")
            .filter((day == 1) | F.col("r_name").isNotNull())
            .select(
                "date",
                F.lit("Holiday").alias("type"),
                F.when(day == 1, "National").otherwise("Regional").alias("locale"),
                F.when(day == 1, NATIONAL).otherwise(F.col("r_name")).alias("locale_name"),
                ((day == 1) & (month == 6)).alias("transferred"),
            )
        )

    @cached_property
    def stored_holidays(self) -> DataFrame:
        """The listed holidays as a written table, for jobs that read them several times."""
        return materialize(self.holidays_raw, "bronze_holidays")

    @cached_property
    def series(self) -> DataFrame:
        """Dense panel: one row per date, family and state.

        Summed straight from the sold items: the daily fact per store in between
        would be shuffled at nearly the size of the items.
        """
        sold = self.at_stores(self._sold.withColumnRenamed("l_suppkey", "store_nbr"), "state")
        return self._daily(self._dated(sold, "state"), "state")

    @cached_property
    def pred(self) -> DataFrame:
        """Actuals ``y`` with the observation seven rows earlier as prediction."""
        week_ago = F.lag("sales", 7).over(Window.partitionBy("family", "state").orderBy("date"))
        return (
            self.series.select("date", "family", "state", F.col("sales").alias("y"), week_ago.alias("prediction"))
            .filter(F.col("prediction").isNotNull())
        )

    def lagged_sales(self, *lags: int) -> DataFrame:
        """The daily fact with ``lag_<n>`` of its sales per store and family."""
        w = Window.partitionBy("store_nbr", "family").orderBy("date")
        return self.stored_sales.select("*", *[F.lag("sales", n).over(w).alias(f"lag_{n}") for n in lags])

    @cached_property
    def recent_sales(self) -> DataFrame:
        """The last days with ``lag_1`` to ``lag_3``, written once for all predictions made from them."""
        return materialize(self.last_days(self.lagged_sales(1, 2, 3), FORECAST_DAYS), "recent_sales")

    @cached_property
    def scenario_pred(self) -> DataFrame:
        """Forecast horizon under the current and the doubled promotion plan."""
        horizon = self.recent_sales.filter(F.col("lag_1").isNotNull())
        uplift = F.col("lag_1") * (1 + F.lit(PROMOTION_UPLIFT) * F.col("onpromotion"))
        plans = F.array(
            F.struct(F.lit("current").alias("scenario"), F.col("lag_1").alias("predicted_sales")),
            F.struct(F.lit("onpromotion_2x").alias("scenario"), uplift.alias("predicted_sales")),
        )
        return horizon.select("date", "store_nbr", "family", F.inline(plans)).select(
            "date", "store_nbr", "family", "predicted_sales", "scenario"
        )

    @cached_property
    def validation_pred(self) -> DataFrame:
        """Validation rows: the last 28 days with the previous observation as prediction."""
        rows = self.last_days(self.recent_sales.filter(F.col("lag_1").isNotNull()), FUTURE_DAYS)
        return rows.select("date", "store_nbr", "family", "sales", F.col("lag_1").alias("predicted_sales"))

    @cached_property
    def model_pred(self) -> DataFrame:
        """Stored predictions of two models, the first of them in two versions."""
        horizon = self.recent_sales
        runs = (
            ("previous", "v1", "lag_1", 1, "2002-01-01 00:00:00"),
            ("previous", "v2", "lag_2", 2, "2002-01-02 00:00:00"),
            ("third", "v1", "lag_3", 3, "2002-01-01 00:00:00"),
        )
        versions = F.array(
            *[
                F.struct(
                    F.lit(name).alias("model_name"),
                    F.lit(version).alias("model_version"),
                    F.col(column).alias("prediction"),
                    F.lit(iteration).alias("best_iteration"),
                    F.lit(at).cast("timestamp_ntz").alias("prediction_timestamp"),
                )
                for name, version, column, iteration, at in runs
            ]
        )
        return (
            horizon.select("date", "store_nbr", "family", F.inline(versions))
            .filter(F.col("prediction").isNotNull())
            .withColumns(
                {
                    "model_type": F.lit("lag"),
                    "model_strategy": F.lit("global"),
                    "split": F.lit("test"),
                }
            )
        )

    @cached_property
    def stored_predictions(self) -> DataFrame:
        """The same as a written table."""
        return materialize(self.model_pred, "predictions")

    @cached_property
    def retrained_pred(self) -> DataFrame:
        """Predictions of the retrained first model, over a longer horizon than before."""
        horizon = self.last_days(self.lagged_sales(4), RETRAINED_DAYS)
        return (
            horizon.filter(F.col("lag_4").isNotNull())
            .select("date", "store_nbr", "family", F.col("lag_4").alias("prediction"))
            .withColumns(
                {
                    "model_name": F.lit("previous"),
                    "model_version": F.lit("v3"),
                    "model_type": F.lit("lag"),
                    "model_strategy": F.lit("global"),
                    "best_iteration": F.lit(4),
                    "split": F.lit("test"),
                    "prediction_timestamp": F.lit("2002-01-03 00:00:00").cast("timestamp_ntz"),
                }
            )
        )

    @cached_property
    def price_feed(self) -> DataFrame:
        """One price per day, as the feed delivers it."""
        events = self.table("events").filter(F.col("event_type") == "purchase")
        return events.groupBy(F.col("ts").cast("date").alias("day")).agg(_exact_mean("value").alias("price"))
