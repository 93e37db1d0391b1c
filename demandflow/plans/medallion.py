"""Bronze to gold in order (M9-M12, X16): silver tables are written, gold is built from them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from demandflow.operators.clean import clean_future, clean_sales, clean_stores, fill_gaps, holiday_calendar
from demandflow.operators.encode import category_codes, category_values
from demandflow.operators.enrich import CATEGORIES, enrich, gold_daily_fact
from demandflow.session import materialize_all
from demandflow.sources.retail import NATIONAL, Retail


class Medallion:
    """Silver and gold frames over the retail tables.

    The dimensions are written once, which makes their row counts a footer read:
    the joins broadcast them when small and shuffle otherwise. Tables that do not
    depend on each other are written side by side.
    """

    def __init__(self, retail: Retail):
        self.retail = retail
        self._silver: dict[str, DataFrame] = {}

    def _define(self, name: str) -> DataFrame:
        r = self.retail
        if name == "stores":
            return clean_stores(r.stores)
        if name == "bronze_holidays":
            return r.holidays_raw
        if name == "holidays":
            stores, listed = self.silver("stores", "bronze_holidays")
            return holiday_calendar(listed, stores, NATIONAL)
        if name == "oil":
            return fill_gaps(r.oil_raw, "date", "dcoilwtico")
        if name == "oil_ahead":
            # Prices up to the last day to forecast; days after the last quote keep its price.
            return fill_gaps(r.oil_raw, "date", "dcoilwtico", until=r.last_sale)
        if name == "train":
            return self.train
        if name == "codes":
            return self._define_codes()
        raise KeyError(name)

    def _define_codes(self) -> DataFrame:
        """Dictionary fitted on the training side only."""
        (train,) = self.silver("train")
        values = category_values(train, ["family"])
        places = [c for c in CATEGORIES if c != "family"]
        return category_codes(values.unionByName(category_values(self.stores, places)))

    def silver(self, *names: str) -> list[DataFrame]:
        """The named tables, written if they are not yet."""
        missing = {n: self._define(n) for n in names if n not in self._silver}
        self._silver.update(materialize_all(missing))
        return [self._silver[n] for n in names]

    @property
    def stores(self) -> DataFrame:
        return self.silver("stores")[0]

    @property
    def holidays(self) -> DataFrame:
        return self.silver("holidays")[0]

    @property
    def oil(self) -> DataFrame:
        return self.silver("oil")[0]

    @property
    def codes(self) -> DataFrame:
        self.silver("stores", "train")
        return self.silver("codes")[0]

    @cached_property
    def train(self) -> DataFrame:
        return clean_sales(self.retail.sales_raw)

    @cached_property
    def test(self) -> DataFrame:
        return clean_future(self.retail.future_raw)

    @cached_property
    def training(self) -> DataFrame:
        stores, oil, train, _ = self.silver("stores", "oil", "train", "bronze_holidays")
        holidays, codes = self.silver("holidays", "codes")
        return enrich(train.select("date", "store_nbr", "family", "sales", "onpromotion"), stores, holidays, oil, codes)

    @cached_property
    def testing(self) -> DataFrame:
        stores, oil, _, _ = self.silver("stores", "oil_ahead", "train", "bronze_holidays")
        holidays, codes = self.silver("holidays", "codes")
        return enrich(self.test.select("date", "store_nbr", "family", "onpromotion"), stores, holidays, oil, codes)

    @cached_property
    def gold(self) -> DataFrame:
        stores, oil, _ = self.silver("stores", "oil", "bronze_holidays")
        return gold_daily_fact(self.train, stores, self.holidays, oil)

    @cached_property
    def gold_with_transactions(self) -> DataFrame:
        stores, oil, _ = self.silver("stores", "oil", "bronze_holidays")
        return gold_daily_fact(self.train, stores, self.holidays, oil, self.retail.stored_transactions)
