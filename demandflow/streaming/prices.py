"""Incremental price feed: JSON files -> bronze -> silver -> price dimension.

Both hops are stateless appends, so they need no watermark: a late price is just
a new date. Progress lives in the checkpoint folder of each hop; a restarted hop
goes on where the last one ended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.operators.clean import keep_first
from demandflow.operators.merge import merge_insert_only
from demandflow.sources.contracts import PRICE_FEED

FILES_PER_BATCH = 1000
PRICES = T.StructType([T.StructField("date", T.DateType()), T.StructField("dcoilwtico", T.DoubleType())])


@dataclass(frozen=True)
class FeedPaths:
    """Folders of one feed: landed files, the three tables and their progress."""

    landing: str
    bronze: str
    silver: str
    prices: str
    progress: str

    @classmethod
    def below(cls, root: str) -> FeedPaths:
        return cls(*[f"{root}/{part}" for part in ("landing", "bronze", "silver", "prices", "progress")])


def _append(stream: DataFrame, target: str, progress: str) -> None:
    """Append everything available to a Parquet table, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def ingest(spark: SparkSession, paths: FeedPaths) -> None:
    """New JSON files into the bronze table; files already read are skipped."""
    landed = spark.readStream.schema(PRICE_FEED).option("maxFilesPerTrigger", FILES_PER_BATCH).json(paths.landing)
    _append(landed, paths.bronze, f"{paths.progress}/bronze")


def refine(spark: SparkSession, paths: FeedPaths) -> None:
    """New bronze rows under the names and types of the price dimension into the silver table."""
    bronze = spark.readStream.schema(PRICE_FEED).parquet(paths.bronze)
    rows = bronze.select(F.to_date("day").alias("date"), F.col("price").cast("double").alias("dcoilwtico"))
    _append(rows, paths.silver, f"{paths.progress}/silver")


def run_feed(spark: SparkSession, paths: FeedPaths) -> DataFrame:
    """Both hops over whatever is new; returns the silver table."""
    ingest(spark, paths)
    refine(spark, paths)
    return spark.read.parquet(paths.silver)


def merge_prices(prices: DataFrame, streamed: DataFrame) -> DataFrame:
    """Add dates the price table lacks. Gap filling comes after this, not before."""
    return merge_insert_only(prices, streamed, ["date"])


def current_prices(spark: SparkSession, root: str) -> DataFrame:
    """The price table."""
    return spark.read.schema(PRICES).parquet(root)


def stream_into_prices(spark: SparkSession, paths: FeedPaths, prices: DataFrame) -> DataFrame:
    """Append the dates that the price table lacks from each new micro-batch of the bronze table.

    ``prices`` seeds the table on the first run. What was appended once is found in
    the table, so a batch that is replayed, or all of them after a lost checkpoint, adds nothing
    twice. The table itself is never rewritten.
    """
    try:
        current_prices(spark, paths.prices)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        prices.select(*PRICES.names).write.parquet(paths.prices)

    def append(batch: DataFrame, batch_id: int) -> None:
        rows = keep_first(batch.dropna(subset=["date"]), ["date"])
        known = current_prices(batch.sparkSession, paths.prices).select("date")
        rows.join(known, "date", "left_anti").select(*PRICES.names).write.mode("append").parquet(paths.prices)

    bronze = spark.readStream.schema(PRICE_FEED).parquet(paths.bronze)
    rows = bronze.select(F.to_date("day").alias("date"), F.col("price").cast("double").alias("dcoilwtico"))
    query = (
        rows.writeStream.foreachBatch(append)
        .option("checkpointLocation", f"{paths.progress}/merge")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return current_prices(spark, paths.prices)
