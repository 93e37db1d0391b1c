"""Shared parts of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.plans.medallion import Medallion
from demandflow.sources.retail import Retail

RUN_AT = "2002-02-01 00:00:00"
SERIES = ("family", "state")
STORE_SERIES = ("store_nbr", "family")
DIGITS = 6  # comparison precision of inexact figures


def retail(spark: SparkSession, folder: str) -> Retail:
    return Retail(spark, folder)


def tiers(spark: SparkSession, folder: str) -> Medallion:
    return Medallion(Retail(spark, folder))


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    """Round inexact columns, by default all doubles, so that equal figures compare equal."""
    names = columns or [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(f"`{c}`", digits) for c in names})
