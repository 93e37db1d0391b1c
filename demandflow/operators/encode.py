"""Dictionary codes and hashed categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import FeatureHasher
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandflow.session import BROADCAST_ROWS, is_small, materialize

HASH_BUCKETS = 1024  # fixed value


def category_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The distinct values of several text columns as (category, value), in one pass."""
    return df.select(*cols).unpivot([], list(cols), "category", "value").dropna(subset=["value"]).distinct()


def category_codes(values: DataFrame) -> DataFrame:
    """The sorted values of each category, numbered from 0.

    ``values`` are distinct (category, value) pairs. Dictionaries of ordinary size
    are numbered by a window per category, larger ones without one.
    """
    values = materialize(values, "category_values")
    if is_small(values):
        code = F.row_number().over(Window.partitionBy("category").orderBy("value")) - 1
        return values.withColumn("code", code)
    return number_sorted(values)


def number_sorted(values: DataFrame) -> DataFrame:
    """The same numbering for dictionaries of any size.

    The pairs are range-sorted and written. A code is the position within the
    category's part of its sorted chunk plus the category's rows in earlier chunks;
    no task sees more than its chunk, even if one category holds most values.
    """
    ordered = values.orderBy("category", "value").withColumn("_id", F.monotonically_increasing_id())
    # The upper bits of the id are the chunk, the lower 33 bits the position in it.
    chunks = materialize(ordered, "sorted_values").select(
        "category",
        "value",
        F.shiftright("_id", 33).alias("_chunk"),
        F.col("_id").bitwiseAND((1 << 33) - 1).alias("_position"),
    )
    # One row per chunk and category: as many as tasks and encoded columns.
    sizes = chunks.groupBy("_chunk", "category").agg(F.count(F.lit(1)).alias("_n"), F.min("_position").alias("_first"))
    in_order = Window.partitionBy("category").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_chunk", "category", "_first", F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_before"))
    return chunks.join(F.broadcast(offsets), ["_chunk", "category"]).select(
        "category", "value", (F.col("_position") - F.col("_first") + F.col("_before")).cast("int").alias("code")
    )


def encode(df: DataFrame, codes: DataFrame, cols: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Add the code of each column; a value not in its dictionary gets the next free code."""
    known = {r["category"]: r["count"] for r in codes.groupBy("category").count().collect()}  # one row per column
    for col in cols:
        named = codes.filter(F.col("category") == col).select(F.col("value").alias(col), F.col("code").alias(col + suffix))
        size = known.get(col, 0)
        df = df.join(F.broadcast(named) if size <= BROADCAST_ROWS else named, col, "left").withColumn(
            col + suffix, F.coalesce(col + suffix, F.when(F.col(col).isNotNull(), size))
        )
    return df


def hashed_features(df: DataFrame, cols: Sequence[str], out: str = "hash_features") -> DataFrame:
    """Categorical columns as one sparse vector of 1024 hash buckets."""
    return FeatureHasher(inputCols=list(cols), outputCol=out, numFeatures=HASH_BUCKETS).transform(df)
