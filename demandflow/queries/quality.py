"""Data-quality checks and row-level filtering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.operators import quality as q
from demandflow.operators.policy import CityPolicy, publish_view
from demandflow.queries import query
from demandflow.queries.common import retail, tiers
from demandflow.sources.contracts import CONTRACTS

POLICY = CityPolicy(city="NATION_11")
READERS = {
    "admin": ("admins",),
    "local": ("city_readers",),
    "elsewhere": ("other_readers",),
    "both": ("city_readers", "other_readers"),
    "nobody": (),
}


@query
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return q.duplicate_keys(retail(spark, folder).sales_raw, ["id"])


@query
def orphan_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Sales of days without a price."""
    t = tiers(spark, folder)
    return q.orphan_rows(t.retail.sales, t.oil, "date", "date")


@query
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return q.null_profile(retail(spark, folder).sales_raw)


@query
def grain_profile(spark: SparkSession, folder: str) -> DataFrame:
    grains = {
        "date": ["date"],
        "date_store": ["date", "store_nbr"],
        "date_family": ["date", "family"],
        "date_store_family": ["date", "store_nbr", "family"],
    }
    return q.grain_profile(tiers(spark, folder).train, grains)


@query
def fd_violations(spark: SparkSession, folder: str) -> DataFrame:
    return q.fd_violations(retail(spark, folder).sales_raw, "id", ["date", "store_nbr", "family"])


@query
def store_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Stores with more than one type, state or city: none is expected."""
    return q.fd_violations(tiers(spark, folder).gold, "store_nbr", ["store_type", "state", "city"])


@query
def contract_report(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    holidays = r.holidays_raw.withColumn("description", F.lit(None).cast("string"))
    tables = {
        "stores": r.stores,
        "transactions": r.transactions,
        "oil": r.oil_raw,
        "holidays": holidays,
        "train": r.sales_raw,
        "test": r.future_raw,
    }
    return reduce(DataFrame.unionByName, [q.contract_report(c, tables) for c in CONTRACTS.values()])


@query
def schema_diff(spark: SparkSession, folder: str) -> DataFrame:
    t = tiers(spark, folder)
    return q.schema_diff(t.training, t.testing)


@query
def row_policy(spark: SparkSession, folder: str) -> DataFrame:
    """What each kind of reader sees of the daily fact, per city."""
    per_city = (
        tiers(spark, folder).gold.groupBy("city").agg(F.count(F.lit(1)).alias("row_count"), F.sum("sales").alias("sales"))
    )
    readers = F.array(*[F.when(POLICY.predicate(groups), reader) for reader, groups in READERS.items()])
    return per_city.select(F.explode(F.array_compact(readers)).alias("reader"), "city", "row_count", "sales")


@query
def visible_cities(spark: SparkSession, folder: str) -> DataFrame:
    """the cities a reader outside the city sees, sorted within partitions."""
    publish_view(tiers(spark, folder).gold.select("city"), POLICY, READERS["elsewhere"], "cities_for_reader")
    return spark.sql("SELECT DISTINCT city FROM cities_for_reader SORT BY city")


@query
def row_policy_view(spark: SparkSession, folder: str) -> DataFrame:
    """The fact as a reader outside the city sees it, through a view filtered by a SQL function."""
    groups = READERS["elsewhere"]
    POLICY.register(spark, groups, "may_see_city")
    publish_view(tiers(spark, folder).gold, POLICY, groups, "gold_for_reader")
    return spark.sql("SELECT city, store_nbr, date, family, sales FROM gold_for_reader WHERE may_see_city(city)")
