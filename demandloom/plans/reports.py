"""Questions planners ask of the gold relations. Every report is one grouping over a fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.calendar import shift_month_end
from demandloom.functions.series import share_of
from demandloom.operators.joins import lookup_join


def top_n(df: DataFrame, by: str, n: int, tie_break: list[str], descending: bool = True) -> DataFrame:
    """First `n` rows by a measure; each task keeps only `n`, ties resolved by `tie_break`."""
    order = F.col(by).desc() if descending else F.col(by).asc()
    return df.orderBy(order, *tie_break).limit(n)


# --- demand -------------------------------------------------------------------

def ds_demand(gold) -> DataFrame:
    """Shipments with the item attributes reports group by."""
    items = gold.dim_item.select(
        "item_code", "item_name", "item_category", "item_type", "demand_class", "is_domestic_only")
    return lookup_join(gold.fct_shipments, items, "item_code", "inner").select(
        "ym", "channel", "item_code", "item_name", "item_category", "item_type",
        "demand_class", "is_domestic_only", "qty", "amount")


def monthly_totals(gold) -> DataFrame:
    return gold.fct_shipments.groupBy("ym").agg(F.sum("qty").alias("qty"), F.sum("amount").alias("amount")).orderBy("ym")


def last12_trend(gold) -> DataFrame:
    """Monthly totals of the newest twelve months."""
    recent = gold.fct_shipments.filter(F.col("ym") > shift_month_end(gold.last_month, -12))
    return recent.groupBy("ym").agg(F.sum("qty").alias("qty")).orderBy("ym")


def monthly(df: DataFrame, time: str, measure: Column, name: str, *by: str) -> DataFrame:
    """A measure by calendar month (first day), the grain of the counters and trends."""
    return df.groupBy(F.date_trunc("MONTH", time).cast("date").alias("month"), *by).agg(measure.alias(name))


def w_kpi_qty(gold) -> DataFrame:
    return monthly(gold.fct_shipments, "ym", F.sum("qty"), "qty")


def w_kpi_amount(gold) -> DataFrame:
    return monthly(gold.fct_shipments, "ym", F.sum("amount"), "amount")


def w_kpi_error(gold) -> DataFrame:
    return monthly(gold.fct_forecast_accuracy, "target_ym", F.avg("abs_error"), "avg_abs_error")


def w_trend_by_channel(gold) -> DataFrame:
    return monthly(gold.fct_shipments, "ym", F.sum("qty"), "qty", "channel")


def w_qty_by_category(gold) -> DataFrame:
    return ds_demand(gold).groupBy("item_category").agg(F.sum("qty").alias("qty")).orderBy(F.col("qty").desc())


def channel_share(gold) -> DataFrame:
    """Quantity per channel and its share of all quantity."""
    per = gold.fct_shipments.groupBy("channel").agg(F.sum("qty").alias("qty"))
    # the window is unpartitioned on purpose: its input is one row per channel
    total = F.sum("qty").over(Window.partitionBy())
    return per.withColumn("share", share_of(F.col("qty").cast("double"), total.cast("double")))


def domestic_items(gold) -> DataFrame:
    """Domestic-only items by mean monthly quantity."""
    rows = ds_demand(gold).filter("is_domestic_only")
    return rows.groupBy("item_code", "item_name").agg(
        share_of(F.sum("qty"), F.count_distinct("ym")).alias("avg_monthly_qty")
    ).orderBy(F.col("avg_monthly_qty").desc(), "item_code")


def top_items(gold, n: int = 10) -> DataFrame:
    per = gold.fct_shipments.groupBy("item_code").agg(F.sum("qty").alias("qty"))
    return top_n(per, "qty", n, ["item_code"])


def class_profile(gold) -> DataFrame:
    """Number of items and the range of their statistics per demand class."""
    return gold.dim_item.groupBy("demand_class").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.min("adi").alias("min_adi"), F.max("adi").alias("max_adi"),
        F.min("cv2").alias("min_cv2"), F.max("cv2").alias("max_cv2"),
    ).orderBy(F.col("n_items").desc())


def most_intermittent(gold) -> DataFrame:
    """The item with the longest demand interval among the hard classes."""
    hard = gold.dim_item.filter(F.col("demand_class").isin(*spec.HARD_CLASSES)).select("item_code", "demand_class", "adi")
    return top_n(hard, "adi", 1, ["item_code"])


def horizon(gold, ahead: int = spec.HORIZON_MONTHS, back: int = spec.HOLDOUT_MONTHS) -> DataFrame:
    """Newest month, the end of the forecast horizon and the hold-out cutoff."""
    last = F.max("ym")
    return gold.fct_shipments.agg(
        last.alias("last_ym"), shift_month_end(last, ahead).alias("horizon_ym"),
        shift_month_end(last, -back).alias("cutoff_ym"))


def series_list(gold) -> DataFrame:
    return gold.fct_shipments.select(*spec.SERIES).distinct()


def series_slice(gold, item: str, channel: str) -> DataFrame:
    """Actuals and forecasts of one series on one time axis; both filters reach their source."""
    def one(df: DataFrame) -> DataFrame:
        return df.filter((F.col("item_code") == item) & (F.col("channel") == channel))

    empty = F.lit(None).cast("double")
    actual = one(gold.fct_shipments).select(
        F.col("ym"), F.lit("actual").alias("kind"), F.col("qty").cast("double").alias("value"),
        empty.alias("lower_bound"), empty.alias("upper_bound"))
    forecast = one(gold.fct_forecast_baseline).select(
        F.col("target_ym").alias("ym"), F.lit("forecast").alias("kind"), F.col("p50").alias("value"),
        "lower_bound", "upper_bound")
    return actual.unionByName(forecast)


# --- inventory ----------------------------------------------------------------

def ds_inventory(gold) -> DataFrame:
    """Stock positions of items that should be stocked."""
    stocked = gold.fct_inventory.filter(F.col("safety_stock_qty") > 0)
    items = gold.dim_item.select("item_code", "item_name", "item_category")
    return lookup_join(stocked, items, "item_code", "inner").select(
        "ym", "site_code", "item_code", "item_name", "item_category",
        "closing_qty", "safety_stock_qty", "surplus_qty", "stockout_flag")


def w_stock_by_site(gold) -> DataFrame:
    return ds_inventory(gold).groupBy("site_code").agg(
        F.avg("closing_qty").alias("avg_closing"), F.avg("safety_stock_qty").alias("avg_safety"))


def w_stockouts(gold) -> DataFrame:
    """Months without stock per item and site."""
    return ds_inventory(gold).groupBy("item_code", "site_code").agg(F.sum("stockout_flag").alias("stockout_months"))


def newest_stock(gold) -> DataFrame:
    return gold.fct_inventory.filter(F.col("ym") == gold.last_stock_month)


def inventory_health(gold) -> DataFrame:
    """Newest stock position with lead time and item attributes."""
    newest = newest_stock(gold)
    items = gold.dim_item.select("item_code", "item_name", "item_category")
    timed = newest.join(gold.dim_lead_time, ["item_code", "site_code"], "left")
    return lookup_join(timed, items, "item_code", "inner").select(
        "item_code", "site_code", "ym", "item_name", "item_category", "closing_qty",
        "safety_stock_qty", "surplus_qty", "stockout_flag", "standard_lead_time_days")


def latest_stockouts(gold) -> DataFrame:
    """Items out of stock in the newest month."""
    return inventory_health(gold).filter(F.col("stockout_flag") == 1).select(
        "item_code", "item_name", "site_code", "safety_stock_qty").orderBy("item_code", "site_code")


def surplus_sites(gold) -> DataFrame:
    """Sites whose newest stock exceeds their safety stock."""
    return newest_stock(gold).groupBy("site_code").agg(F.sum("surplus_qty").alias("surplus_qty")).filter(F.col("surplus_qty") > 0)


def top_lead_times(gold, n: int = 10) -> DataFrame:
    return top_n(gold.dim_lead_time, "standard_lead_time_days", n, ["item_code", "site_code"])
