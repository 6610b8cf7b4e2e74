"""Demand statistics, demand classes and forecastability routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.calendar import latest, month_number


def demand_stats(ship: DataFrame, by: list[str], last_month: Column | None = None) -> DataFrame:
    """Interval between demands, variability of non-zero demand and mean of the last 12 months.

    Measured on the total of each `by` group from its first month with demand to
    `last_month` (that of the relation unless given); a group that never had demand gets
    NULL statistics.
    """
    last = month_number(latest(ship) if last_month is None else last_month)
    monthly = ship.groupBy(*by, "ym").agg(F.sum("qty").alias("qty"))
    hit = F.col("qty") > 0
    # whole numbers, so that the order of adding up cannot show
    whole = F.when(hit, F.col("qty").cast("decimal(18,0)"))
    month = month_number("ym")
    grouped = monthly.groupBy(*by).agg(
        F.min(F.when(hit, F.col("ym"))).alias("launch_ym"),
        F.count_if(hit).alias("_hits"),
        F.sum(whole).alias("_sum"),
        F.sum(whole * whole).alias("_squares"),
        F.sum(F.when(month > last - 12, F.col("qty"))).alias("_recent"),
    )
    months = last - month_number("launch_ym") + 1
    square = F.col("_sum") * F.col("_sum")
    spread = F.col("_hits").cast("decimal(10,0)") * F.col("_squares") - square
    return grouped.select(
        *by, "launch_ym",
        months.alias("months"),
        F.col("_hits").alias("nonzero_months"),
        F.try_divide(months, F.col("_hits")).alias("adi"),
        F.try_divide(spread.cast("double"), square.cast("double")).alias("cv2"),
        (F.coalesce(F.col("_recent"), F.lit(0)) / F.least(F.lit(12), months)).alias("mean_qty"),
    )


def demand_class(adi: Column | str = "adi", cv2: Column | str = "cv2") -> Column:
    """Quadrant of interval and variability, with extreme variability set apart."""
    adi = F.col(adi) if isinstance(adi, str) else adi
    cv2 = F.col(cv2) if isinstance(cv2, str) else cv2
    often, steady = adi < spec.ADI_CUT, cv2 < spec.CV2_CUT
    return (
        F.when(adi.isNull(), F.lit(None).cast("string"))
        .when(cv2 >= spec.SEVERE_CV2_CUT, "lumpy_severe")
        .when(often & steady, "smooth")
        .when(often, "erratic")
        .when(steady, "intermittent")
        .otherwise("lumpy")
    )


def classify(ship: DataFrame, by: list[str], last_month: Column | None = None) -> DataFrame:
    return demand_stats(ship, by, last_month).withColumn("demand_class", demand_class())


#: what happens to hard-to-forecast series under each policy: with the others, by a fixed rule, or in a run of their own
ROUTES = {"A": spec.MAIN_ROUTE, "B": "simple_rule", "C": spec.SEPARATE_ROUTE}


def route_series(classified: DataFrame, policy: str = "B") -> DataFrame:
    """Send hard demand classes down the route `policy` names, everything else down the main one."""
    hard = F.coalesce(F.col("demand_class").isin(*spec.HARD_CLASSES), F.lit(True))
    route = F.when(hard, ROUTES[policy]).otherwise(spec.MAIN_ROUTE)
    return classified.withColumn("forecast_source", route)


def history_gate(ship: DataFrame, months: int = spec.MIN_HISTORY_MONTHS) -> DataFrame:
    """Months from the first to the last of each series, with demand or without, and whether they
    suffice for a model-based forecast."""
    length = month_number(F.max("ym")) - month_number(F.min("ym")) + 1
    return ship.groupBy(*spec.SERIES).agg(length.cast("bigint").alias("months")).withColumn(
        "enough_history", F.col("months") >= months
    )


def enough_history(ship: DataFrame, months: int = spec.MIN_HISTORY_MONTHS) -> DataFrame:
    """Rows of the series that pass the history gate."""
    passing = history_gate(ship, months).filter("enough_history")
    return ship.join(passing.select(*spec.SERIES), spec.SERIES, "left_semi")
