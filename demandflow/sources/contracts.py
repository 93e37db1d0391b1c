"""Declared schemas and keys of the retail tables (A1, K2-K4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    """Schema, primary key and foreign keys (column -> (table, column)) of one table."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    foreign: tuple[tuple[str, str, str], ...] = ()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_int, _long, _dbl, _str, _date = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType()

STORES = Contract(
    "stores",
    _schema(
        ("store_nbr", _long, False),
        ("city", _str, True),
        ("state", _str, True),
        ("type", _str, True),
        ("cluster", _int, True),
    ),
    ("store_nbr",),
)

TRANSACTIONS = Contract(
    "transactions",
    _schema(("date", _date, False), ("store_nbr", _long, False), ("transactions", _int, True)),
    ("date", "store_nbr"),
    (("store_nbr", "stores", "store_nbr"),),
)

OIL = Contract("oil", _schema(("date", _date, False), ("dcoilwtico", _dbl, True)), ("date",))

HOLIDAYS = Contract(
    "holidays",
    _schema(
        ("date", _date, False),
        ("type", _str, False),
        ("locale", _str, False),
        ("locale_name", _str, False),
        ("description", _str, True),
        ("transferred", T.BooleanType(), True),
    ),
    ("date", "type", "locale", "locale_name"),
)

TRAIN = Contract(
    "train",
    _schema(
        ("id", _long, False),
        ("date", _date, False),
        ("store_nbr", _long, False),
        ("family", _str, False),
        ("sales", _dbl, True),
        ("onpromotion", _int, True),
    ),
    ("date", "store_nbr", "family"),
    (("store_nbr", "stores", "store_nbr"),),
)

TEST = Contract(
    "test",
    _schema(
        ("id", _long, False),
        ("date", _date, False),
        ("store_nbr", _long, False),
        ("family", _str, False),
        ("onpromotion", _int, True),
    ),
    ("id",),
    (("store_nbr", "stores", "store_nbr"),),
)

DAILY_SALES = _schema(
    ("date", _date, True),
    ("store_nbr", _long, True),
    ("family", _str, True),
    ("sales", _dbl, True),
    ("onpromotion", _int, True),
)

PRICE_FEED = _schema(("day", _date, True), ("price", _dbl, True))

# Timestamps carry no zone, so results do not depend on the session time zone.
FORECAST_FACT = _schema(
    ("date", _date, False),
    ("family", _str, False),
    ("store_nbr", _long, False),
    ("sales", _dbl, True),
    ("forecast", _dbl, True),
    ("split", _str, True),
    ("record_type", _str, False),
    ("model_name", _str, True),
    ("model_type", _str, True),
    ("model_version", _str, True),
    ("model_strategy", _str, True),
    ("best_iteration", _int, True),
    ("prediction_timestamp", T.TimestampNTZType(), True),
    ("created_at", T.TimestampNTZType(), True),
    ("updated_at", T.TimestampNTZType(), True),
)

CONTRACTS = {c.name: c for c in (STORES, TRANSACTIONS, OIL, HOLIDAYS, TRAIN, TEST)}
