"""Seasonal-naive baseline: the same month last year, else two years ago."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.calendar import earliest, latest, shift_month_end
from demandloom.functions.series import ratio_interval


Span = tuple[Column, Column]


def span_of(ship: DataFrame) -> Span:
    """First and last month of the shipments."""
    return earliest(ship), latest(ship)


def seasonal_naive(ship: DataFrame, horizon: int = spec.HORIZON_MONTHS, span: Span | None = None) -> DataFrame:
    """History and future block of the baseline in one pass.

    Instead of looking back with two self-joins, every actual is sent forward to the two
    months it can serve (12 and 24 later); one grouping per series and target then picks
    the nearer one. Targets run from the first month plus 12 to the last plus `horizon`;
    history targets are dated one month ahead, future ones at the last month. `span` gives
    the first and last month where the caller has them cheaper than from `ship`.
    """
    first, last = span or span_of(ship)
    sent = ship.select(*spec.SERIES, "ym", "qty", F.explode(F.array(F.lit(12), F.lit(24))).alias("_back"))
    sent = sent.select(*spec.SERIES, shift_month_end("ym", F.col("_back")).alias("target_ym"), "qty", "_back")
    sent = sent.filter(F.col("target_ym").between(shift_month_end(first, 12), shift_month_end(last, horizon)))
    picked = sent.groupBy(*spec.FORECAST_KEY).agg(
        F.coalesce(
            F.max(F.when(F.col("_back") == 12, F.col("qty"))),
            F.max(F.when(F.col("_back") == 24, F.col("qty"))),
        ).cast("double").alias("p50")
    )
    low, high = ratio_interval(F.col("p50"), spec.BASELINE_RATIO, whole=True)
    run = F.when(F.col("target_ym") > last, last).otherwise(shift_month_end("target_ym", -1))
    return picked.select(
        *spec.FORECAST_KEY, run.alias("forecast_run_ym"), F.lit(spec.BASELINE_MODEL).alias("model_name"),
        "p50", low.alias("lower_bound"), high.alias("upper_bound"),
    )


def baseline_history(ship: DataFrame, span: Span | None = None) -> DataFrame:
    return seasonal_naive(ship, 0, span)


def baseline_future(ship: DataFrame, horizon: int = spec.HORIZON_MONTHS, span: Span | None = None) -> DataFrame:
    span = span or span_of(ship)
    return seasonal_naive(ship, horizon, span).filter(F.col("target_ym") > span[1])


def rolling_rule(ship: DataFrame, rule: str) -> DataFrame:
    """One-month-ahead forecasts of a simple rule over the history, for comparison.

    `mean_12` is the mean of the previous twelve months, `last_value` the previous month;
    both start where twelve months are known.
    """
    by_time = Window.partitionBy(*spec.SERIES).orderBy("ym")
    rules = {
        "mean_12": F.avg("qty").over(by_time.rowsBetween(-12, -1)),
        "last_value": F.lag("qty").over(by_time).cast("double"),
    }
    rows = ship.select(*spec.SERIES, F.col("ym").alias("target_ym"), rules[rule].alias("p50"),
                       F.row_number().over(by_time).alias("_nth"))
    low, high = ratio_interval(F.col("p50"), spec.MODEL_RATIO)
    return rows.filter(F.col("_nth") > 12).select(
        *spec.FORECAST_KEY, shift_month_end("target_ym", -1).alias("forecast_run_ym"),
        F.lit(rule).alias("model_name"), "p50", low.alias("lower_bound"), high.alias("upper_bound"))
