"""Parts shared by the text-corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"  # what separates words; other white space belongs to words
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text column, a missing text being empty."""
    return F.coalesce(df[name], F.lit(""))


def join_null_safe(left: DataFrame, right: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """Join on the named columns, null matching null; the keys come from ``left``, other names must differ."""
    renamed = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
    condition = F.lit(True)
    for n in names:
        condition = condition & F.col(n).eqNullSafe(F.col(f"_right_{n}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{n}" for n in names])


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that working columns cannot clash with them."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def file_place(docs: DataFrame) -> Column | None:
    """File (64-bit hash of its path) and row number in it, of the rows of one written Parquet table.

    The same in every read, whatever executors do it. None if the rows come from no files.
    ``docs`` must be the table as read: rows that a join made of it share places.
    """
    try:
        at = docs.metadataColumn("_metadata")
        place = F.struct(F.xxhash64(at["file_path"]).alias("file"), at["row_index"].alias("row"))
        docs.select(place).schema  # noqa: B018  the names are resolved here
    except AnalysisException:
        return None
    return place
