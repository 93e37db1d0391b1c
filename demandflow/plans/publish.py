"""All tiers as named tables, each built from the tables written before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.operators.clean import clean_future, clean_sales, clean_stores, fill_gaps, holiday_calendar
from demandflow.operators.encode import category_codes, category_values
from demandflow.operators.enrich import CATEGORIES, enrich, gold_daily_fact
from demandflow.operators.metrics import residuals
from demandflow.plans.gold_forecast import sales_and_forecasts, store_forecast_fact
from demandflow.plans.growth import Period, growth_by, growth_delta, scenario_totals, ytd_segments
from demandflow.session import dimension_join, side_by_side
from demandflow.sources.files import with_month_partitions, write_partitioned
from demandflow.sources.retail import NATIONAL, Retail

PARTITIONED = ("silver_train", "silver_test")
SALES_COLUMNS = ("date", "store_nbr", "family", "sales", "onpromotion")


class Tables:
    """Parquet tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.names: list[str] = []

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def write(self, **frames: DataFrame) -> None:
        """Replace the named tables, side by side as they do not depend on each other."""

        def one(name: str) -> None:
            target = f"{self.root}/{name}"
            if name in PARTITIONED:
                write_partitioned(with_month_partitions(frames[name]), target)
            else:
                frames[name].write.mode("overwrite").parquet(target)

        side_by_side(one, frames)
        self.names += [n for n in frames if n not in self.names]


def publish_tiers(r: Retail, root: str, run_at: str) -> Tables:
    """Write bronze, silver, gold and platinum tables in this order."""
    t = Tables(r.spark, root)
    bronze = {
        "bronze_stores": r.stores,
        "bronze_transactions": r.transactions,
        "bronze_oil": r.oil_raw,
        "bronze_holidays": r.holidays_raw,
        "bronze_train": r.sales_raw,
        "bronze_test": r.future_raw,
    }
    # The stored predictions come from the last days of sales, which need no table of a tier.
    side_by_side(lambda job: job(), [lambda: t.write(**bronze), lambda: r.recent_sales])
    last_day = t["bronze_train"].agg(F.max("date"))
    t.write(
        silver_stores=clean_stores(t["bronze_stores"]),
        # Prices reach the last day to forecast; days after the last quote keep its price.
        silver_oil=fill_gaps(t["bronze_oil"], "date", "dcoilwtico", until=last_day),
        silver_train=clean_sales(t["bronze_train"]),
        silver_test=clean_future(t["bronze_test"]),
    )
    stores, oil, train, test = (t[f"silver_{n}"] for n in ("stores", "oil", "train", "test"))
    places = [c for c in CATEGORIES if c != "family"]
    values = category_values(train, ["family"]).unionByName(category_values(stores, places))
    t.write(
        silver_holidays=holiday_calendar(t["bronze_holidays"], stores, NATIONAL),
        silver_codes=category_codes(values),
        silver_test_predictions=r.scenario_pred,
        silver_validation_predictions=residuals(r.validation_pred),
        silver_model_predictions=r.model_pred,
    )
    holidays, codes = t["silver_holidays"], t["silver_codes"]
    future_columns = [c for c in SALES_COLUMNS if c != "sales"]
    enriched = {
        "silver_training": enrich(train.select(*SALES_COLUMNS), stores, holidays, oil, codes),
        "silver_testing": enrich(test.select(*future_columns), stores, holidays, oil, codes),
        "gold_daily_store_family": gold_daily_fact(train.drop("year", "month"), stores, holidays, oil),
    }
    fact = f"{t.root}/gold_sales_forecast"
    side_by_side(
        lambda job: job(),
        [lambda: t.write(**enriched), lambda: store_forecast_fact(fact, r.stored_sales, t["silver_model_predictions"], run_at)],
    )
    gold = t["gold_daily_store_family"]
    t.names.append("gold_sales_forecast")
    cities = stores.select("store_nbr", "city")
    stack = sales_and_forecasts(
        gold,
        dimension_join(t["silver_test_predictions"], cities, "store_nbr"),
        dimension_join(t["silver_validation_predictions"], cities, "store_nbr"),
    )
    period = Period.of(stack)
    t.write(platinum_totals=scenario_totals(ytd_segments(stack, period)))
    totals = t["platinum_totals"]
    t.write(platinum_city_cagr=growth_by(totals, "city", period), platinum_family_cagr=growth_by(totals, "family", period))
    t.write(platinum_family_cagr_delta=growth_delta(t["platinum_family_cagr"]))
    return t
