"""Row-level filtering by the reader's groups."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CityPolicy:
    """Administrators see all rows; one group sees a single city, another all other cities."""

    city: str
    admin_group: str = "admins"
    city_group: str = "city_readers"
    other_group: str = "other_readers"

    def predicate(self, groups: Collection[str], city_col: str = "city") -> Column:
        """L1: which rows a reader in ``groups`` may see; an unknown city only shows to administrators."""
        if self.admin_group in groups:
            return F.lit(True)
        allowed = F.lit(False)
        if self.city_group in groups:
            allowed = allowed | (F.col(city_col) == self.city)
        if self.other_group in groups:
            allowed = allowed | (F.col(city_col) != self.city)
        return F.coalesce(allowed, F.lit(False))

    def register(self, spark: SparkSession, groups: Collection[str], name: str) -> None:
        """The predicate as a temporary SQL function of the city."""
        city = self.city.replace("'", "''")
        if self.admin_group in groups:
            body = "true"
        else:
            parts = ["false"]
            if self.city_group in groups:
                parts.append(f"city = '{city}'")
            if self.other_group in groups:
                parts.append(f"city <> '{city}'")
            body = f"coalesce({' OR '.join(parts)}, false)"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(city STRING) RETURNS BOOLEAN RETURN {body}")


def apply_row_policy(df: DataFrame, policy: CityPolicy, groups: Collection[str], city_col: str = "city") -> DataFrame:
    """L1: the rows of ``df`` a reader may see."""
    return df.filter(policy.predicate(groups, city_col))


def publish_view(df: DataFrame, policy: CityPolicy, groups: Collection[str], view: str) -> DataFrame:
    """L2: attach the policy to a table by giving the reader a filtered view of it."""
    apply_row_policy(df, policy, groups).createOrReplaceTempView(view)
    return df.sparkSession.table(view)
