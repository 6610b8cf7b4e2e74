"""Demand relations derived from an order-line star schema.

Binds `lineitem part supplier nation region` to the demand model, so that every relation
(and every query on it) grows with those tables. Shipments start from the order lines:
one aggregation with map-side combine brings any number of lines, however they are
spread over keys, down to one row per series and month before anything else happens.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.calendar import month_end
from demandloom.operators.baseline import seasonal_naive
from demandloom.operators.demand import classify
from demandloom.operators.densify import densify
from demandloom.operators.inventory import safety_stock, stockout_flag

# part types that count as main items, and the month that is sent twice
MAIN_TYPES = ("ECONOMY", "STANDARD")
RESEND_MONTH = 6


def channel_of(flag: Column | str) -> Column:
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.when(flag == "N", "DOM").when(flag == "A", "EXP").otherwise("RET")


class StarSchema:
    """Silver-shaped relations over one folder of star-schema parquet files.

    Complete months count: those before the month of `as_of`, or, where that is not given, those up
    to the newest line, whose own month counts if the line falls on its last day.
    """

    def __init__(self, spark: SparkSession, folder: str, grain: str = "item", as_of: str | None = None) -> None:
        if grain not in ("item", "part"):
            raise ValueError(f"grain must be item or part, not {grain}")
        self.spark, self.folder, self.grain, self.as_of = spark, folder, grain, as_of

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def before(self) -> date | None:
        """First day that no longer counts; None without lines. One aggregate over one column."""
        if self.as_of is not None:
            return date.fromisoformat(self.as_of).replace(day=1)
        newest = self.table("lineitem").agg(F.max(F.col("l_shipdate").cast("date"))).head()[0]
        return newest and (newest + timedelta(days=1)).replace(day=1)

    def _lines(self, *columns: str) -> DataFrame:
        """Order lines of complete months; the date filter reaches the file scan."""
        before = F.lit(self.before and str(self.before)).cast("timestamp_ntz")
        return self.table("lineitem").filter(F.col("l_shipdate") < before).select("l_partkey", "l_shipdate", *columns)

    @cached_property
    def parts(self) -> DataFrame:
        code = F.concat_ws("_", "p_brand", "p_type") if self.grain == "item" else F.col("p_partkey").cast("string")
        return self.table("part").select("p_partkey", code.alias("item_code"), "p_type", "p_brand", "p_retailprice")

    @cached_property
    def _span(self) -> DataFrame:
        """First and last complete month, from one column of the order lines."""
        day = F.col("l_shipdate").cast("date")
        return self._lines().agg(month_end(F.min(day)).alias("first_ym"), month_end(F.max(day)).alias("last_ym"))

    @cached_property
    def months(self) -> DataFrame:
        """Every complete month that has lines."""
        return self._lines().select(month_end(F.col("l_shipdate").cast("date")).alias("ym")).distinct()

    @property
    def first_month(self) -> Column:
        return self._span.select("first_ym").scalar()

    @property
    def last_month(self) -> Column:
        return self._span.select("last_ym").scalar()

    @property
    def last_stock_month(self) -> Column:
        return self.last_month

    @cached_property
    def sparse_shipments(self) -> DataFrame:
        """Quantity per item, channel and month that had any."""
        lines = self._lines("l_returnflag", "l_quantity").select(
            F.col("l_partkey").alias("p_partkey"), channel_of("l_returnflag").alias("channel"),
            month_end(F.col("l_shipdate").cast("date")).alias("ym"), "l_quantity",
        )
        joined = lines.join(self.parts.select("p_partkey", "item_code"), "p_partkey")
        return joined.groupBy(*spec.SHIPMENT_KEY).agg(
            F.sum("l_quantity").cast("bigint").alias("qty")
        )

    @cached_property
    def shipments(self) -> DataFrame:
        """Gap-free shipments of every series over the whole calendar."""
        return densify(self.sparse_shipments, spec.SERIES, "ym", "qty", self.first_month, self.last_month)

    @cached_property
    def item_stats(self) -> DataFrame:
        return classify(self.sparse_shipments, ["item_code"], self.last_month)

    @cached_property
    def items(self) -> DataFrame:
        """Item master; statistics, class and whether anything was exported are measured, the rest
        comes from the parts."""
        # an item code holds one brand and type, so grouping by all three stays a hash aggregate
        master = self.parts.groupBy("item_code", F.col("p_type").alias("item_category"), F.col("p_brand").alias("_brand")).agg(
            F.floor(F.min("p_retailprice")).cast("int").alias("unit_price"))
        kind = F.when(F.col("item_category").isin(*MAIN_TYPES), "main").otherwise("consumable")
        exports = F.sum(F.when(F.col("channel") == "EXP", F.col("qty")).otherwise(0))
        exported = self.sparse_shipments.groupBy("item_code").agg(exports.alias("_exported"))
        return master.join(self.item_stats, "item_code").join(exported, "item_code").select(
            "item_code",
            F.concat_ws(" ", "_brand", "item_category").alias("item_name"),
            "item_category", kind.alias("item_type"), "unit_price", "demand_class", "adi", "cv2",
            (F.col("_exported") == 0).alias("is_domestic_only"), "launch_ym",
        )

    @cached_property
    def channels(self) -> DataFrame:
        """The channels the business knows; returns are deliberately not among them."""
        code = F.col("channel_code")
        found = self._lines("l_returnflag").select(channel_of("l_returnflag").alias("channel_code")).distinct()
        return found.filter(code.isin(*spec.CHANNELS)).select(
            code,
            F.when(code == "DOM", "Domestic").otherwise("Export").alias("channel_name"),
            F.when(code == "DOM", "Domestic dealers and direct sales").otherwise("Overseas dealers").alias("description"),
        )

    @cached_property
    def _supply(self) -> DataFrame:
        """Order lines with item and supplying site.

        The tables are joined one after the other, not nested: Spark then sees the stored
        size of each and can keep the lines where they are when a table is small.
        """
        lines = self._lines("l_suppkey", "l_quantity", "l_linestatus").select(
            F.col("l_partkey").alias("p_partkey"), "l_suppkey", "l_linestatus", "l_quantity",
            month_end(F.col("l_shipdate").cast("date")).alias("ym"),
        )
        supplier = self.table("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
        nation = self.table("nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
        region = self.table("region").select("r_regionkey", F.col("r_name").alias("site_code"))
        placed = lines.join(self.parts.select("p_partkey", "item_code"), "p_partkey").join(supplier, "l_suppkey")
        return placed.join(nation, "n_nationkey").join(region, "r_regionkey")

    @cached_property
    def inventory(self) -> DataFrame:
        """Month-end stock per item and site: the open part of the month's lines is the closing
        quantity, safety stock follows the trailing demand."""
        keys = ["item_code", "site_code"]
        open_qty = F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0))
        monthly = self._supply.groupBy(*keys, "ym").agg(
            F.sum("l_quantity").cast("bigint").alias("qty"), open_qty.cast("bigint").alias("closing_qty")
        )
        dense = densify(monthly, keys, "ym", ["qty", "closing_qty"], self.first_month, self.last_month)
        stocked = safety_stock(dense, keys)
        return stocked.select(
            *keys, "ym", "closing_qty", "safety_stock_qty",
            stockout_flag(F.col("closing_qty"), F.col("safety_stock_qty")).alias("stockout_flag"),
        )

    @cached_property
    def lead_time(self) -> DataFrame:
        days = (F.min(F.col("l_suppkey") % 60) + 1).cast("int")
        return self._supply.groupBy("item_code", "site_code").agg(days.alias("standard_lead_time_days"))

    @cached_property
    def forecast_baseline(self) -> DataFrame:
        return seasonal_naive(self.shipments, span=(self.first_month, self.last_month))

    @cached_property
    def bronze_shipments(self) -> DataFrame:
        """Shipments as received: first-of-month dates, plus a later resend of every June."""
        first = self.sparse_shipments.select(
            "item_code", "channel", F.trunc("ym", "month").alias("ym"), "qty",
            F.lit("a.csv").alias("_source_file"),
            F.lit("2001-11-02 00:00:00").cast("timestamp").alias("_ingested_at"),
        )
        resent = self.sparse_shipments.filter(F.month("ym") == RESEND_MONTH).select(
            "item_code", "channel", "ym", (F.col("qty") + 1).alias("qty"),
            F.lit("b.csv").alias("_source_file"),
            F.lit("2001-11-03 00:00:00").cast("timestamp").alias("_ingested_at"),
        )
        return first.unionByName(resent)


def bronze_copy(silver: DataFrame, change: dict[str, Column]) -> DataFrame:
    """A relation as received twice: an older copy with `change` applied, then the right one."""
    def stamped(df: DataFrame, name: str, day: str) -> DataFrame:
        return df.withColumns({
            "_source_file": F.lit(name), "_ingested_at": F.lit(f"2001-11-{day} 00:00:00").cast("timestamp"),
        })

    older = stamped(silver.withColumns(change), "a.csv", "02")
    return older.unionByName(stamped(silver, "b.csv", "03"))
