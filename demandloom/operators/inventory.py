"""Safety stock and month-end stock positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.series import half_up


def safety_stock(demand: DataFrame, keys: list[str], months: float = spec.SAFETY_MONTHS,
                 share: Column | float = 1.0) -> DataFrame:
    """Trailing-12 mean demand (current month included) times `share` times `months`, half up.

    `demand` holds one `qty` per key and month without gaps; the window of a key is never
    longer than the calendar.
    """
    share = F.lit(share) if isinstance(share, (int, float)) else share
    trailing = Window.partitionBy(*keys).orderBy("ym").rowsBetween(-11, 0)
    base = F.avg("qty").over(trailing) * share
    return demand.withColumn("safety_stock_qty", half_up(base * months).cast("bigint"))


def site_demand(ship: DataFrame, site_of_channel: dict[str, dict[str, float]]) -> DataFrame:
    """Split channel demand over the sites that serve it: {channel: {site: share}}."""
    served = F.create_map(*[
        x for channel, sites in site_of_channel.items()
        for x in (F.lit(channel), F.array(*[F.struct(F.lit(s).alias("site_code"), F.lit(float(r)).alias("share"))
                                            for s, r in sites.items()]))
    ])
    return ship.select("*", F.explode(served[F.col("channel")]).alias("_s")).select(*ship.columns, "_s.*")


def planned_safety_stock(ship: DataFrame, items: DataFrame,
                         site_of_channel: dict[str, dict[str, float]] = spec.SITES_OF_CHANNEL) -> DataFrame:
    """Safety stock per item, site and month from the site's share of its channel's demand.

    Months before launch carry zero, and the trailing mean starts at launch.
    """
    split = site_demand(ship, site_of_channel).join(items.select("item_code", "launch_ym"), "item_code")
    live = F.col("ym") >= F.col("launch_ym")
    keys = ["item_code", "site_code"]
    trailing = Window.partitionBy(*keys).orderBy("ym").rowsBetween(-11, 0)
    base = F.avg(F.when(live, F.col("qty"))).over(trailing) * F.col("share")
    planned = F.when(live, half_up(base * spec.SAFETY_MONTHS)).otherwise(0).cast("bigint")
    return split.select(*keys, "ym", F.col("qty").alias("demand_qty"), planned.alias("safety_stock_qty"))


def stockout_flag(closing: Column, safety: Column) -> Column:
    """1 when nothing is left of something that should be stocked."""
    return F.when((closing == 0) & (safety > 0), 1).otherwise(0)

