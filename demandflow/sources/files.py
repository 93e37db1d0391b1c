"""File readers and writers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.sources.contracts import Contract


def load_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """A1: CSV with header read under a fixed schema.

    ``FAILFAST`` stops at the first malformed line; ``PERMISSIVE`` keeps it as
    nulls with the raw line in ``_corrupt_record``.
    """
    if mode == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType(), True)])
    return spark.read.schema(schema).option("enforceSchema", "false").csv(path, header=True, mode=mode)


def ingest_csv(spark: SparkSession, path: str, contract: Contract, target: str) -> DataFrame:
    """Load one CSV table under its contract and replace the target table."""
    load_csv(spark, path, contract.schema).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def load_inferred(
    spark: SparkSession, files: Mapping[str, str]
) -> tuple[dict[str, DataFrame], list[str]]:
    """A2: read a dictionary of CSV files with inferred types; also name the missing ones."""
    frames: dict[str, DataFrame] = {}
    missing: list[str] = []
    for name, path in files.items():
        try:
            frames[name] = spark.read.csv(path, header=True, inferSchema=True)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    return frames, missing


def append_table(df: DataFrame, target: str) -> None:
    """Append to an existing table, matching its columns by name."""
    existing = df.sparkSession.read.parquet(target)
    align_to_schema(df, existing.schema).write.mode("append").parquet(target)


def with_month_partitions(df: DataFrame, date_col: str = "date") -> DataFrame:
    """The derived partition columns ``year`` and ``month``."""
    return df.withColumns({"year": F.year(date_col), "month": F.month(date_col)})


def write_partitioned(
    df: DataFrame, target: str, by: Sequence[str] = ("year", "month"), mode: str = "overwrite"
) -> None:
    """Partitioned table with few files per partition value.

    The rebalance hint clusters rows by partition value, so that no task opens a
    file for every value, and lets the adaptive planner split a hot value over
    several tasks and join small ones.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(target)


def read_evolving(spark: SparkSession, *paths: str) -> DataFrame:
    """Read tables written under different schema versions as one, missing columns null."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def align_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """A10: exactly the target's columns, order and types.

    Absent columns become null; values that do not convert become null as well.
    """
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )


def write_json_lines(df: DataFrame, target: str) -> None:
    """Append JSON lines, the landing format of the price feed."""
    df.write.mode("append").json(target)


def rows_to_frame(spark: SparkSession, rows: Iterable[Mapping[str, str]], schema: T.StructType) -> DataFrame:
    """Records of text values, such as one API response, as a typed frame."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], text)
    return align_to_schema(raw, schema)


def export_parquet(df: DataFrame, target: str, single_file: bool = False) -> None:
    """Export a result; one file only on request and only for small results."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").parquet(target)


def export_csv(df: DataFrame, target: str) -> None:
    """Metrics table as CSV with header."""
    df.write.mode("overwrite").csv(target, header=True)


def read_tagged_csv(spark: SparkSession, pattern: str, schema: T.StructType, stem: str, tag: str) -> DataFrame:
    """Every CSV matching a glob as one frame, each row tagged with the name of its file.

    The tag is the path part that matches the regular expression ``stem``.
    """
    return spark.read.schema(schema).csv(pattern, header=True).withColumn(
        tag, F.regexp_extract(F.col("_metadata.file_path"), stem, 0)
    )
