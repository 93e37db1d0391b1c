"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.session import TASK_ROWS, materialize, sized, spread
from demandflow.sources.contracts import Contract


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """K1, K2: keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def assert_unique(df: DataFrame, key: Sequence[str], shown: int = 5) -> None:
    """K1: fail, naming some offending keys, when a key repeats."""
    found = duplicate_keys(df, key).limit(shown).collect()
    if found:
        raise ValueError(f"several rows for one {list(key)}: {[tuple(r)[:-1] for r in found]}")


def orphan_rows(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """K3: rows whose foreign key has no parent; a null key is not checked."""
    keys = parent.select(F.col(parent_col).alias(child_col)).distinct()
    return child.dropna(subset=[child_col]).join(sized(keys), child_col, "left_anti")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column the number of rows and of nulls, in one pass."""
    cols = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols],
    )
    return counts.unpivot("row_count", cols, "column_name", "null_count").select("column_name", "row_count", "null_count")


def grain_profile(df: DataFrame, grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows and distinct keys of several candidate grains.

    The rows are first reduced to the distinct combinations of all the columns
    involved, so that the distinct counts work on what is left of heavy keys. These are written and
    counted grain by grain: few keys are made distinct in the tasks first, many keys are
    spread by their number, so that no task holds more of them the larger the table is.
    """
    used = sorted({c for key in grains.values() for c in key})
    combos = materialize(df.groupBy(*used).agg(F.count(F.lit(1)).alias("_rows")), "combinations")
    keys = {name: F.struct(*key) for name, key in grains.items()}
    about = combos.agg(
        F.count(F.lit(1)), F.sum("_rows"), *[F.approx_count_distinct(key) for key in keys.values()]
    ).first()
    n, row_count, sizes = about[0], F.lit(about[1]).cast("bigint"), dict(zip(grains, about[2:], strict=True))

    def counted(name: str) -> DataFrame:
        key = list(dict.fromkeys(grains[name]))
        if sorted(key) == used:
            distinct = combos  # made distinct above
        else:
            some = combos.select(*key)
            distinct = (some if sizes[name] <= TASK_ROWS else spread(some, n, *key)).distinct()
        return distinct.agg(F.lit(name).alias("grain"), F.count(F.lit(1)).alias("distinct_keys"))

    counts = reduce(DataFrame.unionByName, [counted(name) for name in grains]).withColumn("row_count", row_count)
    return counts.withColumn("is_unique", F.col("distinct_keys") == F.col("row_count"))


def fd_violations(df: DataFrame, determinant: str, dependents: Sequence[str]) -> DataFrame:
    """K6: values of a column that go with several combinations of the dependent columns."""
    return (
        df.select(determinant, *dependents)
        .distinct()
        .groupBy(determinant)
        .agg(F.count(F.lit(1)).alias("combinations"))
        .filter("combinations > 1")
    )


def missing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """The distinct rows of one frame that another lacks.

    Both sides are made distinct first, so a row that repeats very often is
    shuffled once per task.
    """
    return left.distinct().subtract(right.distinct())


def contract_report(contract: Contract, tables: Mapping[str, DataFrame]) -> DataFrame:
    """K2-K4: one row per declared rule of a table with the number of violations."""
    df = tables[contract.name]

    def rule(name: str, violations: DataFrame) -> DataFrame:
        return violations.agg(
            F.lit(contract.name).alias("table_name"),
            F.lit(name).alias("rule"),
            F.count(F.lit(1)).alias("violations"),
        )

    report = rule(f"key({', '.join(contract.key)})", duplicate_keys(df, contract.key))
    nulls = null_profile(df, contract.required).select(
        F.lit(contract.name).alias("table_name"),
        F.concat(F.lit("not_null("), "column_name", F.lit(")")).alias("rule"),
        F.col("null_count").alias("violations"),
    )
    report = report.unionByName(nulls)
    for column, parent, parent_column in contract.foreign:
        missing = orphan_rows(df, tables[parent], column, parent_column)
        report = report.unionByName(rule(f"foreign({column} -> {parent}.{parent_column})", missing))
    return report


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every column with its non-null count on each side, null where a side lacks it."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return null_profile(df).select("column_name", (F.col("row_count") - F.col("null_count")).alias(name))

    joined = side(left, "left_values").join(side(right, "right_values"), "column_name", "full_outer")
    return joined.withColumn(
        "present_in",
        F.when(F.col("right_values").isNull(), "left").when(F.col("left_values").isNull(), "right").otherwise("both"),
    )


def daily_total(df: DataFrame, day: str, measure: str = "sales") -> DataFrame:
    """Total of one day, to compare with a known figure."""
    return df.filter(F.col("date") == F.lit(day).cast("date")).agg(F.sum(measure).alias("total"))


def describe(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Min, mean, max and sample deviation of a column."""
    return df.groupBy(*by).agg(
        F.min(column).alias(f"min_{column}"),
        F.avg(column).alias(f"avg_{column}"),
        F.max(column).alias(f"max_{column}"),
        F.stddev_samp(column).alias(f"std_{column}"),
    )
