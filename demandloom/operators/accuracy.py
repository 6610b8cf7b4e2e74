"""Forecast-versus-actual scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.series import abs_error, ape, within


def score(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Each forecast that has an actual, with its error in units and as a share."""
    truth = actual.select(*spec.SERIES, F.col("ym").alias("target_ym"), "qty")
    qty, p50 = F.col("qty"), F.col("p50")
    keep = [c for c in forecast.columns if c not in ("p50", "lower_bound", "upper_bound")]
    return forecast.join(truth, spec.FORECAST_KEY).select(
        *keep,
        p50.alias("forecast_qty"),
        qty.alias("actual_qty"),
        abs_error(qty, p50).alias("abs_error"),
        ape(qty, p50).alias("ape"),
        within(qty, F.col("lower_bound"), F.col("upper_bound")).alias("within_interval"),
    )


def all_forecasts(sources: list[DataFrame]) -> DataFrame:
    """Every method's forecasts on the columns they share."""
    return reduce(DataFrame.unionByName, [s.select(*spec.FORECAST_COLUMNS) for s in sources])


def accuracy_all(sources: list[DataFrame], actual: DataFrame) -> DataFrame:
    """All methods scored against the same actuals with one join."""
    return score(all_forecasts(sources), actual)


def common_support(accuracy: DataFrame) -> DataFrame:
    """Only the points every method has forecast, so that averages cover the same months.

    A window group is one point: as many rows as there are methods.
    """
    methods = accuracy.select(F.count_distinct("model_name")).scalar()
    here = F.size(F.collect_set("model_name").over(Window.partitionBy(*spec.FORECAST_KEY)))
    return accuracy.withColumn("_n", here).filter(F.col("_n") == methods).drop("_n")


def unscorable(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Span and size of what each method forecast for months that have no actual."""
    truth = actual.select(*spec.SERIES, F.col("ym").alias("target_ym"))
    return (
        forecast.join(truth, spec.FORECAST_KEY, "left_anti")
        .groupBy("model_name")
        .agg(F.min("target_ym").alias("first_ym"), F.max("target_ym").alias("last_ym"),
             F.count(F.lit(1)).alias("n"))
    )
