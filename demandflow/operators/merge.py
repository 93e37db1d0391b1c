"""Merges on tables without a transaction log.

A merge returns the new content. The caller writes it to a new folder and points
readers there; the folder being read is never overwritten. The source is written
once, as it is read for the check, the updates and the inserts.
``upsert_partitions`` instead replaces, in a partitioned table, just the partitions
the source falls into.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.operators.clean import keep_first
from demandflow.session import is_small, materialize, sized


def _same(keys: Sequence[str], renamed: str) -> Column:
    """The keys equal those with the prefix ``renamed``; a null key equals a null key."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{renamed}{k}")) for k in keys])


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def merge_insert_only(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """C14: add source rows whose key the target lacks; among source rows of one key the first is taken.

    A null key is a key like others.
    """
    rows = materialize(keep_first(source.select(*target.columns), key), "merge_source")
    return target.unionByName(_unmatched(rows, target, key, is_small(rows)))


def merge_upsert(
    target: DataFrame, source: DataFrame, key: Sequence[str], update: Sequence[str] | None = None
) -> DataFrame:
    """Update the named columns of matched rows, insert unmatched source rows whole.

    ``update`` defaults to all non-key columns. Several source rows for one key
    are an error, as the result would depend on their order. Null keys match null
    keys, so repeating an upsert changes nothing.
    """
    keys = list(key)
    columns = target.columns
    changed = [c for c in columns if c not in keys] if update is None else list(update)
    rows = materialize(source.select(*columns), "merge_source")
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if (per_key.agg(F.max("n")).first()[0] or 0) > 1:
        raise ValueError(f"source has several rows for one {keys}")
    small = is_small(rows)
    named = [F.col(c).alias(f"_new_{c}") for c in dict.fromkeys([*keys, *changed])]
    renamed = rows.select(*named, F.lit(True).alias("_matched"))
    merged = target.join(F.broadcast(renamed) if small else renamed, _same(keys, "_new_"), "left").select(
        *[F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in changed else c for c in columns]
    )
    return merged.unionByName(_unmatched(rows, target, keys, small))


def upsert_partitions(
    target: str,
    schema: T.StructType,
    source: DataFrame,
    key: Sequence[str],
    parts: Sequence[str],
    update: Sequence[str] | None = None,
    match: Column | None = None,
) -> DataFrame:
    """C15 on a stored table: only the partitions of the source rows are read, merged and replaced.

    The key must determine the partition; a null partition is one like others. ``match`` limits which target rows may
    be updated, the others are kept. The merged partitions are complete in a
    scratch table before the first of them is replaced, and repeating the call
    after a failure gives the same result.
    """
    spark = source.sparkSession
    table = spark.read.schema(schema).parquet(target)
    rows = materialize(source.select(*schema.names), "merge_source")
    bounds = rows.agg(
        F.count(F.lit(1)).alias("n"), *[f(p).alias(f"{n}_{p}") for p in parts for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    if not bounds["n"]:
        return table
    # The range prunes folders at any number of partitions; the null-safe join then names them exactly.
    for p in parts:
        inside = F.lit(False) if bounds[f"lo_{p}"] is None else F.col(p).between(bounds[f"lo_{p}"], bounds[f"hi_{p}"])
        table = table.filter(F.col(p).isNull() | inside)
    touched = materialize(rows.select(*parts).distinct(), "touched_partitions")
    affected = table.join(sized(_renamed(touched, parts, "_part_")), _same(parts, "_part_"), "left_semi")
    if match is None:
        merged = merge_upsert(affected, rows, key, update)
    else:
        matches = F.coalesce(match, F.lit(False))
        merged = merge_upsert(affected.filter(matches), rows, key, update).unionByName(affected.filter(~matches))
    replaced = materialize(merged, "merged_partitions")
    (
        replaced.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(target)
    )
    return spark.read.schema(schema).parquet(target)


def _unmatched(rows: DataFrame, target: DataFrame, key: Sequence[str], small: bool) -> DataFrame:
    """Source rows whose key the target lacks.

    With a small source the target is only filtered by the broadcast source keys,
    never shuffled; the keys it has in common are again no more than the source's.
    """
    keys = list(key)
    theirs = target.select(*keys)
    if small:
        theirs = theirs.join(F.broadcast(_renamed(rows.select(*keys), keys, "_key_")), _same(keys, "_key_"), "left_semi")
        theirs = theirs.distinct()
    return rows.join(_renamed(theirs, keys, "_key_"), _same(keys, "_key_"), "left_anti")
