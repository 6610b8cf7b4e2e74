"""How good each forecast is, in units and in percent, by class, month and method."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.calendar import shift_month_end
from demandloom.functions.series import abs_error, share_of, smape_term
from demandloom.operators.joins import lookup_join
from demandloom.plans.reports import top_n


def error_measures() -> list[Column]:
    """Percent error skips months without shipments; the interval hit rate does not."""
    return [
        F.count(F.lit(1)).alias("n"),
        (F.avg("ape") * 100).alias("ape_pct"),
        F.avg("abs_error").alias("avg_abs_error"),
        (F.avg("within_interval") * 100).alias("hit_pct"),
    ]


def ds_accuracy(gold) -> DataFrame:
    """Scored forecasts with item attributes."""
    items = gold.dim_item.select("item_code", "item_category", "demand_class")
    return lookup_join(gold.fct_forecast_accuracy, items, "item_code", "inner").select(
        "target_ym", "model_name", "item_code", "item_category", "demand_class",
        "actual_qty", "forecast_qty", "abs_error", "ape", "within_interval")


def accuracy_by_class(gold) -> DataFrame:
    return ds_accuracy(gold).groupBy("demand_class").agg(*error_measures()).orderBy(F.col("ape_pct").desc())


def w_err_by_class(gold) -> DataFrame:
    return ds_accuracy(gold).groupBy("demand_class").agg(
        F.avg("ape").alias("avg_ape"), F.avg("abs_error").alias("avg_abs_error"))


def ape_by_month(gold) -> DataFrame:
    return gold.fct_forecast_accuracy.groupBy("target_ym").agg(F.avg("ape").alias("avg_ape")).orderBy("target_ym")


def top_error_items(gold, n: int = 10) -> DataFrame:
    per = gold.fct_forecast_accuracy.groupBy("item_code").agg(F.avg("abs_error").alias("avg_abs_error"))
    return top_n(per, "avg_abs_error", n, ["item_code"])


def accuracy_by_series(gold) -> DataFrame:
    return gold.fct_forecast_accuracy.groupBy(*spec.SERIES).agg(*error_measures())


def accuracy_by_model(accuracy: DataFrame) -> DataFrame:
    return accuracy.groupBy("model_name").agg(*error_measures()).orderBy("avg_abs_error")


def distinct_counts(accuracy: DataFrame) -> DataFrame:
    """Methods, series and months that could be scored."""
    return accuracy.agg(
        F.count_distinct("model_name").alias("models"),
        F.count_distinct(*spec.SERIES).alias("series"),
        F.count_distinct("target_ym").alias("months"))


def smape_by_model(accuracy: DataFrame) -> DataFrame:
    term = smape_term(F.col("actual_qty"), F.col("forecast_qty"))
    return accuracy.groupBy("model_name").agg(F.avg(term).alias("smape"))


def vs_baseline(accuracy: DataFrame, baseline: str = spec.BASELINE_MODEL) -> DataFrame:
    """Mean error per method and its ratio to the baseline's; below 1 beats the baseline."""
    per = accuracy.groupBy("model_name").agg(F.avg("abs_error").alias("err_qty"), F.count(F.lit(1)).alias("n"))
    # the window is unpartitioned on purpose: its input is one row per method
    reference = F.max(F.when(F.col("model_name") == baseline, F.col("err_qty"))).over(Window.partitionBy())
    return per.withColumn("vs_baseline", share_of(F.col("err_qty"), reference)).orderBy("err_qty")


def versus(model: DataFrame, baseline: DataFrame, actual: DataFrame) -> DataFrame:
    """Errors of the model and of the baseline in one relation, told apart by `src`."""
    def tagged(df: DataFrame, src: str) -> DataFrame:
        return df.select(*spec.FORECAST_KEY, F.lit(src).alias("src"), "p50")

    both = tagged(model, "model").unionByName(tagged(baseline, "baseline"))
    truth = actual.select(*spec.SERIES, F.col("ym").alias("target_ym"), "qty")
    return both.join(truth, spec.FORECAST_KEY).select(
        *spec.FORECAST_KEY, "src", abs_error(F.col("qty"), F.col("p50")).alias("abs_err"))


def side_by_side(errors: DataFrame, by: str) -> DataFrame:
    """Mean error of both sides per group, their ratio and who wins."""
    def mean(src: str) -> Column:
        return F.avg(F.when(F.col("src") == src, F.col("abs_err")))

    model, base = F.col("model_err"), F.col("baseline_err")
    return errors.groupBy(by).agg(mean("model").alias("model_err"), mean("baseline").alias("baseline_err")).withColumns({
        "vs_baseline": share_of(model, base),
        "judge": F.when(model < base, "model").otherwise("baseline"),
    })


def class_judge(model: DataFrame, baseline: DataFrame, actual: DataFrame, items: DataFrame) -> DataFrame:
    errors = lookup_join(versus(model, baseline, actual), items.select("item_code", "demand_class"), "item_code", "inner")
    return side_by_side(errors, "demand_class").orderBy("vs_baseline")


def error_by_month(model: DataFrame, baseline: DataFrame, actual: DataFrame) -> DataFrame:
    errors = versus(model, baseline, actual)
    return side_by_side(errors, "target_ym").drop("judge", "vs_baseline").orderBy("target_ym")


def pred_vs_actual(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Pairs of shipped and forecast quantity in months that had shipments."""
    truth = actual.filter(F.col("qty") > 0).select(*spec.SERIES, F.col("ym").alias("target_ym"), F.col("qty").alias("actual_qty"))
    return forecast.join(truth, spec.FORECAST_KEY).select(
        *spec.FORECAST_KEY, "actual_qty", F.col("p50").alias("forecast_qty"))


def forecast_coverage(forecast: DataFrame, last_ym: Column) -> DataFrame:
    """Span and size of the part that can be scored and the part that cannot yet."""
    bucket = F.when(F.col("target_ym") > last_ym, "future").otherwise("scorable")
    return forecast.groupBy(bucket.alias("bucket")).agg(
        F.min("target_ym").alias("first_ym"), F.max("target_ym").alias("last_ym"), F.count(F.lit(1)).alias("n"))


def forecast_summary(forecast: DataFrame, n: int = 15) -> DataFrame:
    """Largest series by average forecast, with the widest bounds and number of months."""
    per = forecast.groupBy(*spec.SERIES).agg(
        F.avg("p50").alias("avg_forecast_qty"), F.min("lower_bound").alias("min_lower"),
        F.max("upper_bound").alias("max_upper"), F.count(F.lit(1)).alias("months"))
    return top_n(per, "avg_forecast_qty", n, spec.SERIES)


def interval_width(forecast: DataFrame, items: DataFrame) -> DataFrame:
    """How wide the intervals are per demand class, in units and relative to the forecast."""
    width = F.col("upper_bound") - F.col("lower_bound")
    rows = lookup_join(forecast, items.select("item_code", "demand_class"), "item_code", "inner")
    return rows.groupBy("demand_class").agg(
        F.avg("p50").alias("avg_forecast"), F.avg(width).alias("interval_width"),
        F.avg(share_of(width, F.col("p50"))).alias("width_per_forecast"),
    ).orderBy(F.col("width_per_forecast").desc())


def freshness(actual: DataFrame, accuracy: DataFrame) -> DataFrame:
    """First and newest month of the actuals and of the accuracy table."""
    def span(df: DataFrame, name: str, month: str) -> DataFrame:
        return df.agg(F.min(month).alias("first_ym"), F.max(month).alias("last_ym")).select(
            F.lit(name).alias("relation"), "first_ym", "last_ym")

    return span(actual, "fct_shipments", "ym").unionAll(span(accuracy, "fct_forecast_accuracy_all", "target_ym"))


def next_month_top(forecast: DataFrame, last_ym: Column, n: int = 1) -> DataFrame:
    """The item expected to sell most in the first month after the actuals."""
    ahead = forecast.filter(F.col("target_ym") == shift_month_end(last_ym, 1))
    per = ahead.groupBy("item_code", "target_ym").agg(F.sum("p50").alias("forecast_qty"))
    return top_n(per, "forecast_qty", n, ["item_code"])


def source_spans(sources: dict[str, DataFrame]) -> DataFrame:
    """Span and size of each forecast relation."""
    spans = [
        df.agg(F.min("target_ym").alias("first_ym"), F.max("target_ym").alias("last_ym"), F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("relation"), "first_ym", "last_ym", "n")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionAll, spans)
