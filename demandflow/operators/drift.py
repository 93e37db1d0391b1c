"""Distribution drift between the parts of a split (K7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.session import materialize

FLOOR = 1e-4  # least share of a bin in the stability index
NULL_BIN = -1


def quantile_edges(
    df: DataFrame, features: Sequence[str], bins: int = 10, accuracy: int = 10_000
) -> dict[str, list[float]]:
    """K7: common bin edges of each feature, quantiles of all rows from one mergeable summary per task.

    Equal quantiles, as of a value that many rows have, are one edge. The driver gets ``bins`` - 1 numbers a feature;
    each is off by at most 1 / ``accuracy`` of the rows in rank.
    """
    shares = [k / bins for k in range(1, bins)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias(c) for c in features]).first()
    return {c: sorted(set(found[c] or [])) for c in features}


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """Number of the edges below ``value``; an edge belongs to the bin under it, null and NaN have a bin of their own."""
    number = F.aggregate(F.array(*[F.lit(float(e)) for e in edges]), F.lit(0), lambda n, e: n + (value > e).cast("int"))
    number = number if edges else F.lit(0)
    return F.when(value.isNull() | F.isnan(value), NULL_BIN).otherwise(number)


def bin_counts(
    df: DataFrame, edges: Mapping[str, Sequence[float]], base: Column, other: Column
) -> DataFrame:
    """K7: feature, bin, base_count and other_count, by one pass over ``df``.

    ``base`` and ``other`` are conditions that tell the rows of the two parts. Every row is one value per
    feature, summed up before the shuffle: what travels is a row per feature, bin and task.
    """
    values = [
        F.struct(F.lit(c).alias("feature"), bin_of(F.col(c).cast("double"), e).alias("bin")) for c, e in edges.items()
    ]
    rows = df.select(base.alias("_base"), other.alias("_other"), F.inline(F.array(*values)))
    return (
        rows.groupBy("feature", "bin")
        .agg(F.count_if("_base").alias("base_count"), F.count_if("_other").alias("other_count"))
        .where("base_count + other_count > 0")
    )


def drift(counts: DataFrame) -> DataFrame:
    """K7: per feature the population stability index, the Kolmogorov-Smirnov distance and the null shares of both parts.

    The index is over all bins, the one of nulls included, shares under ``FLOOR`` counting as that. The distance is the
    largest difference of the two distribution functions at a bin edge, over the values that are there; it is
    null where a part has none. ``counts`` has a few rows per feature.
    """
    of_feature = Window.partitionBy("feature")
    upwards = of_feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    known = F.col("bin") != NULL_BIN

    def share(c: str) -> Column:
        return F.try_divide(F.col(c), F.sum(c).over(of_feature))

    def below(c: str) -> Column:
        there = F.when(known, F.col(c)).otherwise(0)
        return F.try_divide(F.sum(there).over(upwards), F.sum(there).over(of_feature))

    rated = counts.select(
        "feature",
        "bin",
        *[share(f"{p}_count").alias(f"{p}_share") for p in ("base", "other")],
        F.abs(below("base_count") - below("other_count")).alias("_apart"),
    )
    a, b = (F.greatest(F.coalesce(F.col(f"{p}_share"), F.lit(0.0)), F.lit(FLOOR)) for p in ("base", "other"))
    nulls = [
        F.coalesce(F.max(F.when(~known, F.col(f"{p}_share"))), F.lit(0.0)).alias(f"{p}_null_share") for p in ("base", "other")
    ]
    return rated.groupBy("feature").agg(
        F.sum((b - a) * F.log(b / a)).alias("psi"),
        F.max(F.when(known, F.col("_apart"))).alias("ks"),
        *nulls,
    )


def split_drift(
    df: DataFrame,
    features: Sequence[str],
    base: str = "train",
    other: str = "test",
    bins: int = 10,
    edges: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """K7: ``drift`` of each feature between two parts of a split, in quantile bins unless ``edges`` are given.

    Rows of other parts do not count. A missing part, or an empty table, gives null distances.
    """
    parts = df.where(F.col("split").isin(base, other))
    edges = edges or quantile_edges(parts, features, bins)
    counts = bin_counts(parts, {c: edges[c] for c in features}, F.col("split") == base, F.col("split") == other)
    return drift(materialize(counts, "drift_bins"))
