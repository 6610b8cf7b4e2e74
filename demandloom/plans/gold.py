"""Facts and dimensions, kept apart and joined at query time."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.calendar import latest
from demandloom.operators.accuracy import score
from demandloom.operators.joins import lookup_join

GOLD_TABLES = (
    "fct_shipments", "dim_item", "dim_channel", "dim_lead_time",
    "fct_inventory", "fct_forecast_baseline", "fct_forecast_accuracy",
)


def fct_shipments(shipments: DataFrame, items: DataFrame) -> DataFrame:
    """Shipments with their value; an unknown item keeps its row and has no value.

    Both factors are widened before multiplying, so large values cannot overflow.
    """
    priced = lookup_join(shipments.select(*spec.SHIPMENT_KEY, "qty"), items.select("item_code", "unit_price"), "item_code")
    amount = F.col("qty").cast("bigint") * F.col("unit_price").cast("bigint")
    return priced.select(*spec.SHIPMENT_KEY, "qty", amount.alias("amount"))


def fct_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.select(
        *spec.SOURCES["inventory"].columns,
        (F.col("closing_qty") - F.col("safety_stock_qty")).alias("surplus_qty"),
    )


@dataclass(frozen=True)
class Silver:
    """The six cleaned relations."""

    shipments: DataFrame
    items: DataFrame
    channels: DataFrame
    inventory: DataFrame
    lead_time: DataFrame
    forecast_baseline: DataFrame

    @property
    def last_month(self) -> Column:
        return latest(self.shipments)

    @property
    def last_stock_month(self) -> Column:
        return latest(self.inventory)


class Gold:
    """The seven business relations, each built when first asked for."""

    def __init__(self, silver) -> None:
        self._silver = silver

    @property
    def last_month(self) -> Column:
        return self._silver.last_month

    @property
    def last_stock_month(self) -> Column:
        return self._silver.last_stock_month

    @cached_property
    def fct_shipments(self) -> DataFrame:
        return fct_shipments(self._silver.shipments, self._silver.items)

    @cached_property
    def dim_item(self) -> DataFrame:
        return self._silver.items.select(*spec.SOURCES["items"].columns)

    @cached_property
    def dim_channel(self) -> DataFrame:
        return self._silver.channels.select(*spec.SOURCES["channels"].columns)

    @cached_property
    def dim_lead_time(self) -> DataFrame:
        return self._silver.lead_time.select(*spec.SOURCES["lead_time"].columns)

    @cached_property
    def fct_inventory(self) -> DataFrame:
        return fct_inventory(self._silver.inventory)

    @cached_property
    def fct_forecast_baseline(self) -> DataFrame:
        return self._silver.forecast_baseline.select(*spec.SOURCES["forecast_baseline"].columns)

    @cached_property
    def fct_forecast_accuracy(self) -> DataFrame:
        return score(self.fct_forecast_baseline, self._silver.shipments)


class StoredGold:
    """The same relations read from the tables of a database."""

    def __init__(self, spark: SparkSession, database: str) -> None:
        for name in GOLD_TABLES:
            setattr(self, name, spark.table(f"{database}.{name}"))

    @property
    def last_month(self) -> Column:
        return latest(self.fct_shipments)

    @property
    def last_stock_month(self) -> Column:
        return latest(self.fct_inventory)
