"""Guarded scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings read as true; everything else, null included, is false.
TRUE_TEXT = ("True", "true", "1")
PERCENT_GUARD = 1e-10


def normalize_flag(value: Column) -> Column:
    """Boolean-like text as 0/1."""
    return F.when(value.cast("string").isin(*TRUE_TEXT), 1).otherwise(0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null unless the denominator is positive."""
    return numerator / F.when(denominator > 0, denominator)


def pct_error(actual: Column, predicted: Column) -> Column:
    """Signed percent error; a zero actual gives 0."""
    return F.coalesce(F.try_divide(actual - predicted, actual) * 100, F.lit(0.0))


def guarded_pct_error(actual: Column, predicted: Column) -> Column:
    """Signed percent error with a tiny constant added to the actual."""
    return (actual - predicted) / (actual + F.lit(PERCENT_GUARD)) * 100


def from_log1p(value: Column) -> Column:
    """H9: back from the log scale, never below zero."""
    return F.greatest(F.expm1(value), F.lit(0.0))
