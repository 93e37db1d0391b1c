"""Readers, writers, merges and the streamed price feed. Written files go below the shared scratch folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.operators import merge
from demandflow.operators.metrics import model_melt, model_pivot, regression_metrics
from demandflow.plans.baselines import seasonal_naive
from demandflow.plans.growth import rows_per_year as count_per_year
from demandflow.queries import query
from demandflow.queries.common import SERIES, retail
from demandflow.session import new_dir
from demandflow.sources import files
from demandflow.sources.contracts import DAILY_SALES, STORES
from demandflow.streaming import prices

BASELINES = ("naive_7", "naive_14", "ma_7")
SALES_KEY = ("date", "store_nbr", "family")


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    landing, target = new_dir(spark, "sales_csv"), new_dir(spark, "bronze_sales")
    files.export_csv(retail(spark, folder).sales, landing)
    files.load_csv(spark, landing, DAILY_SALES).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


@query
def csv_contract_ingest(spark: SparkSession, folder: str) -> DataFrame:
    landing = new_dir(spark, "stores_csv")
    files.export_csv(retail(spark, folder).stores, landing)
    return files.ingest_csv(spark, landing, STORES, new_dir(spark, "bronze_stores"))


@query
def csv_inferred_profile(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    root = new_dir(spark, "raw")
    tables = {"stores": r.stores, "oil": r.oil_raw, "transactions": r.transactions}
    for name, df in tables.items():
        files.export_csv(df, f"{root}/{name}.csv")
    frames, missing = files.load_inferred(spark, {n: f"{root}/{n}.csv" for n in (*tables, "holidays")})
    profiles = [
        df.agg(
            F.lit(name).alias("file"), F.lit("loaded").alias("status"), F.count(F.lit(1)).alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
        )
        for name, df in frames.items()
    ]
    absent = [
        spark.range(1).select(
            F.lit(name).alias("file"), F.lit("missing").alias("status"), F.lit(0).cast("long").alias("row_count"),
            F.lit(0).alias("column_count"),
        )
        for name in missing
    ]
    return reduce(DataFrame.unionByName, [*profiles, *absent])


@query
def scenario_append(spark: SparkSession, folder: str) -> DataFrame:
    target = new_dir(spark, "test_predictions")
    plans = retail(spark, folder).scenario_pred
    plans.filter("scenario = 'current'").write.mode("overwrite").parquet(target)
    doubled = plans.filter("scenario <> 'current'").select("scenario", "predicted_sales", "family", "store_nbr", "date")
    files.append_table(doubled, target)
    return spark.read.parquet(target)


@query
def partitioned_write_prune(spark: SparkSession, folder: str) -> DataFrame:
    """The whole fact is written by month; one year of it is read back."""
    target = new_dir(spark, "silver_train")
    files.write_partitioned(files.with_month_partitions(retail(spark, folder).sales), target)
    return spark.read.parquet(target).filter("year = 1998")


@query
def schema_evolution_union(spark: SparkSession, folder: str) -> DataFrame:
    """Older rows were written before ``onpromotion`` existed, newer ones after."""
    sales = retail(spark, folder).sales
    old, new = new_dir(spark, "sales_v1"), new_dir(spark, "sales_v2")
    change = F.lit("1998-06-01").cast("date")
    sales.filter(F.col("date") < change).drop("onpromotion").write.parquet(old)
    sales.filter(F.col("date") >= change).write.parquet(new)
    return files.read_evolving(spark, old, new).select(*DAILY_SALES.names)


@query
def align_to_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Text columns in another order, with values that do not convert, under the fact's schema."""
    raw = retail(spark, folder).sales_raw
    loose = raw.groupBy("date", "store_nbr", "family").agg(
        F.coalesce(F.sum("sales").cast("bigint").cast("string"), F.lit("n/a")).alias("sales")
    )
    return files.align_to_schema(loose.select("family", "sales", "store_nbr", "date"), DAILY_SALES)


@query
def model_metric_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """Per-model metric files, read back as one table, pivoted by model and melted again."""
    root = new_dir(spark, "metrics")
    stacked = seasonal_naive(retail(spark, folder).series, SERIES, (7, 14), (7,))
    metrics = regression_metrics(stacked, ["model_name", "family"])
    for name in BASELINES:
        export = metrics.filter(F.col("model_name") == name).select("family", "rmse", "mae", "r2")
        files.export_csv(export, f"{root}/model_metrics_{name}")
    schema = T.StructType.fromDDL("family string, rmse double, mae double, r2 double")
    tagged = files.read_tagged_csv(spark, f"{root}/model_metrics_*", schema, "model_metrics_[a-z0-9_]+", "model")
    models = [f"model_metrics_{n}" for n in BASELINES]
    return model_melt(model_pivot(tagged, "family", "model", models), "family", models)


# --- merges --------------------------------------------------------------------------------------


@query
def merge_insert_only(spark: SparkSession, folder: str) -> DataFrame:
    """The feed, and changed prices of dates already known, which must not be taken over."""
    r = retail(spark, folder)
    feed = r.price_feed.select(F.col("day").alias("date"), F.col("price").alias("dcoilwtico"))
    changed = r.oil_raw.withColumn("dcoilwtico", F.col("dcoilwtico") + 1)
    return merge.merge_insert_only(r.oil_raw, feed.unionByName(changed), ["date"])


@query
def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Corrections of the first five rows and the last day's rows again for the day after."""
    r = retail(spark, folder)
    target = r.stored_sales
    corrections = (
        target.orderBy(*SALES_KEY).limit(5).withColumns({"sales": F.col("sales") + 25, "onpromotion": F.lit(1)})
    )
    next_day = target.filter(F.col("date") == r.last_sale.scalar()).withColumn("date", F.date_add("date", 1))
    return merge.merge_upsert(target, corrections.unionByName(next_day), SALES_KEY)


# --- streaming -----------------------------------------------------------------------------------


def _land(spark: SparkSession, folder: str) -> prices.FeedPaths:
    paths = prices.FeedPaths.below(new_dir(spark, "feed"))
    files.write_json_lines(retail(spark, folder).price_feed, paths.landing)
    return paths


@query
def stream_price_ingest(spark: SparkSession, folder: str) -> DataFrame:
    paths = _land(spark, folder)
    prices.ingest(spark, paths)
    return spark.read.parquet(paths.bronze)


@query
def stream_price_silver(spark: SparkSession, folder: str) -> DataFrame:
    return prices.run_feed(spark, _land(spark, folder))


@query
def stream_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of both tables after a first and a second run over the same files."""
    paths = _land(spark, folder)
    counts = []
    for run in ("first", "second"):
        silver = prices.run_feed(spark, paths)
        tables = {"bronze": spark.read.parquet(paths.bronze), "silver": silver}
        counts += [(run, name, df.count()) for name, df in tables.items()]
    return spark.createDataFrame(counts, "run string, table_name string, row_count bigint")


@query
def stream_price_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The streamed prices merged batch by batch into the price table."""
    paths = _land(spark, folder)
    prices.ingest(spark, paths)
    return prices.stream_into_prices(spark, paths, retail(spark, folder).oil_raw)


@query
def rows_per_year(spark: SparkSession, folder: str) -> DataFrame:
    r = retail(spark, folder)
    feed = r.price_feed.select(F.col("day").alias("date"), F.col("price").alias("dcoilwtico"))
    return count_per_year(prices.merge_prices(r.oil_raw, feed))
