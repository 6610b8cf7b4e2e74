"""Grouped and many-model forecasting of monthly series.

A series travels as one row holding its values in month order. It comes from the monthly
fact, which has one row per series and month, so its length is the calendar's however
many raw lines the series has. Cutting windows, scoring, ranking and routing are column
expressions; only the fit itself is a Python function, over Arrow batches of many series.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom import spec
from demandloom.functions.calendar import latest, month_end, month_number, shift_month_end
from demandloom.functions.forecasters import FITTED, MODELS
from demandloom.functions.series import series_id, smape_term, split_series_id
from demandloom.operators import sparse_demand

# Half-width of a 95 % normal interval, and the rules that need no fitting.
Z95 = 1.96
SCORE_DIGITS = 9
RULES = ("naive_12", "mean_12", "last_value", "zero")
#: methods for series with few demands; like the rules, they need no fitting
SPARSE = tuple(sparse_demand.METHODS)

ID, TIME, VALUE = "unique_id", "ds", "y"


def mm_train(ship: DataFrame) -> DataFrame:
    """Series id, month end and value: the shape every many-model step reads."""
    return ship.select(series_id(*spec.SERIES).alias(ID), month_end("ym").alias(TIME), F.col("qty").cast("double").alias(VALUE))


def pack(df: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """One row per series: key, newest month `last_ym`, values in month order `y`.

    The months of a series that a task holds are put together before anything is shuffled, so that
    after gap filling, which leaves a series in one place, only one row a series travels. Those
    rows are then dealt over the configured number of partitions, by a hash of the key since Spark
    drops a second exchange by the key itself. What follows costs CPU rather than bytes, and a given
    count keeps adaptive coalescing from packing these small rows into one task; models and windows
    are fanned out behind it, inside the partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), F.col(value).cast("double").alias("v"))))
    packed = df.groupBy(F.col(key)).agg(F.max(time).alias("last_ym"), points.alias("_points"))
    return packed.select(key, "last_ym", F.transform("_points", lambda p: p["v"]).alias("y")).repartition(parts, F.xxhash64(key))


_CURVE = T.ArrayType(T.DoubleType())


@F.pandas_udf(T.StructType([T.StructField("p50", _CURVE), T.StructField("sd", _CURVE)]))
def _fit(y: pd.Series, model: pd.Series, horizon: pd.Series) -> pd.DataFrame:
    """Forecast every row; rows sharing model, length and horizon are computed as one block.

    A row whose model is unknown or whose fit is not finite comes back NULL.
    """
    out = pd.DataFrame({"p50": [None] * len(y), "sd": [None] * len(y)}, dtype=object)
    length = y.map(len, na_action="ignore").fillna(0)
    blocks = pd.DataFrame({"m": model, "n": length.astype(int), "h": horizon}).groupby(["m", "n", "h"]).indices
    for (name, months, steps), rows in blocks.items():
        if name not in FITTED or months == 0 or steps < 1:
            continue
        mean, sd = FITTED[name](np.stack([np.asarray(v, dtype=float) for v in y.iloc[rows]]), int(steps))
        for i, row in enumerate(rows):
            if np.isfinite(mean[i]).all() and np.isfinite(sd[i]).all():
                out.at[row, "p50"], out.at[row, "sd"] = mean[i], sd[i]
    return out


def _rule(model: Column, y: Column, horizon: Column) -> Column:
    """Forecast of the fixed rules as array expressions, without leaving the JVM."""
    n = F.size(y)
    last12 = F.slice(y, F.greatest(n - 11, F.lit(1)), F.lit(12))
    width = F.size(last12)
    mean = F.aggregate(last12, F.lit(0.0), lambda a, v: a + v) / width
    steps = F.sequence(F.lit(0), horizon - 1)
    by_step = {
        "naive_12": lambda k: F.get(last12, k % width),
        "mean_12": lambda k: mean,
        "last_value": lambda k: F.get(y, n - 1),
        "zero": lambda k: F.lit(0.0),
    }
    chosen = None
    for name, value in by_step.items():
        arm = F.transform(steps, value)
        chosen = F.when(model == name, arm) if chosen is None else chosen.when(model == name, arm)
    return F.when((n > 0) & (horizon > 0), chosen)


def _with_levels(rows: DataFrame) -> DataFrame:
    """Add the months `_n` of each row and what the sparse method it names makes of them, `_level`, unless there already."""
    if "_level" in rows.columns:
        return rows
    own = F.when(F.col("model").isin(*SPARSE), F.col("y"))
    return rows.withColumns({"_n": F.size("y"), "_level": sparse_demand.level(F.col("model"), own)})


def predict(rows: DataFrame, horizon: Column, models: Iterable[str] | None = None) -> DataFrame:
    """Add `p50` and `sd` arrays to rows holding `y` and `model`.

    Rules are evaluated as expressions, sparse methods in blocks of rows, everything else is fitted.
    `models` names what the rows may hold, where that is known, to plan only what is needed.
    """
    rows = rows.withColumn("_h", horizon)
    plain = (*RULES, *SPARSE)
    known = list(models) if models is not None else [*plain, *FITTED]
    simple = rows.filter(F.col("model").isin(*plain))
    p50 = None
    if any(m in SPARSE for m in known):
        simple = _with_levels(simple)
        flat = F.when((F.col("_n") > 0) & (F.col("_h") > 0), F.array_repeat("_level", F.col("_h").cast("int")))
        p50 = F.when(F.col("model").isin(*SPARSE), flat)
    if p50 is None or any(m in RULES for m in known):
        rule = _rule(F.col("model"), F.col("y"), F.col("_h"))
        p50 = rule if p50 is None else p50.otherwise(rule)
    simple = simple.withColumns({"p50": p50, "sd": F.lit(None).cast("array<double>")}).drop("_h", "_n", "_level")
    if all(m in plain for m in known):
        return simple
    rows = rows.drop("_n", "_level")
    fitted = rows.filter(~F.col("model").isin(*plain)).withColumn("_f", _fit("y", "model", "_h")).select(
        *rows.columns, F.col("_f.p50").alias("p50"), F.col("_f.sd").alias("sd")).drop("_h")
    return simple.unionByName(fitted) if any(m in plain for m in known) else fitted


def unpack(predicted: DataFrame, keep: list[str]) -> DataFrame:
    """One row per forecast month: `target_ym`, `p50` and bounds, none of them negative."""
    rows = predicted.select(*keep, "last_ym", "sd", F.posexplode("p50").alias("_k", "_p50"))
    p50, half = F.col("_p50"), Z95 * F.get("sd", F.col("_k"))
    return rows.select(
        *keep, shift_month_end("last_ym", F.col("_k") + 1).alias("target_ym"),
        F.greatest(p50, F.lit(0.0)).alias("p50"),
        F.when(half.isNotNull(), F.greatest(p50 - half, F.lit(0.0))).alias("lower_bound"),
        F.when(half.isNotNull(), F.greatest(p50 + half, F.lit(0.0))).alias("upper_bound"),
    )


# --- one call for all series --------------------------------------------------

def forecast_by_group(df: DataFrame, horizon: str | Column, time_col: str, value_col: str,
                      group_col: str, frequency: str = "ME", model: str = "auto") -> DataFrame:
    """Forecast every group up to the end date `horizon`, one row per group and month.

    `horizon` is a date, not a number of steps, and `frequency` must be month end. Groups
    must be gap-free. Returns `<value>_forecast`, `<value>_lower` and `<value>_upper`.
    """
    if frequency != "ME":
        raise ValueError(f"only month-end series (frequency='ME') are supported, not {frequency!r}")
    if model not in FITTED and model not in RULES and model not in SPARSE:
        raise ValueError(f"unknown model {model!r}")
    end = F.lit(horizon).cast("date") if isinstance(horizon, str) else horizon
    rows = pack(df, group_col, time_col, value_col).withColumns({
        "model": F.lit(model), "_steps": month_number(end) - month_number("last_ym")})
    ahead = rows.filter(F.col("_steps") > 0)
    return unpack(predict(ahead, F.col("_steps"), [model]), [group_col]).select(
        group_col, F.col("target_ym").alias(time_col), F.col("p50").alias(f"{value_col}_forecast"),
        F.col("lower_bound").alias(f"{value_col}_lower"), F.col("upper_bound").alias(f"{value_col}_upper"))


def grouped_forecast(ship: DataFrame, horizon: str | Column | None = None, cutoff: Column | None = None,
                     model: str = "auto", last_month: Column | None = None) -> DataFrame:
    """Forecast relation of all series, by default 18 months past the last actual.

    With `cutoff`, only months up to it are used; the run month is the last month used.
    `last_month` may be given where the caller has it cheaper than from `ship`.
    """
    known = ship if cutoff is None else ship.filter(F.col("ym") <= cutoff)
    run = cutoff if cutoff is not None else latest(ship) if last_month is None else last_month
    horizon = shift_month_end(run, spec.HORIZON_MONTHS) if horizon is None else horizon
    series = known.select(series_id(*spec.SERIES).alias("series_id"), "ym", F.col("qty").cast("double").alias("qty"))
    out = forecast_by_group(series, horizon, "ym", "qty", "series_id", model=model)
    return out.select(
        split_series_id("series_id", 0).alias("item_code"), split_series_id("series_id", 1).alias("channel"),
        F.col("ym").alias("target_ym"), run.alias("forecast_run_ym"), F.lit(spec.GROUPED_MODEL).alias("model_name"),
        F.col("qty_forecast").alias("p50"), F.col("qty_lower").alias("lower_bound"), F.col("qty_upper").alias("upper_bound"))


def backtest_holdout(ship: DataFrame, months: int = spec.HOLDOUT_MONTHS, model: str = "auto",
                     last_month: Column | None = None) -> DataFrame:
    """Hide the newest `months`, forecast them from the rest."""
    last = latest(ship) if last_month is None else last_month
    return grouped_forecast(ship, horizon=last, cutoff=shift_month_end(last, -months), model=model)


# --- many models --------------------------------------------------------------

def backtest_windows(horizon: int, backtest: int, stride: int) -> int:
    """Number of full evaluation windows that fit into the backtest span."""
    if backtest < horizon:
        raise ValueError(f"backtest length ({backtest}) is shorter than the horizon ({horizon})")
    return (backtest - horizon) // stride + 1


def _with_models(rows: DataFrame, models: Iterable[str]) -> DataFrame:
    """One row per series and model. What the sparse methods make of a series is worked out before, in one go."""
    models = list(models)
    if not any(m in SPARSE for m in models):
        return rows.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    rows = rows.withColumns({"_n": F.size("y"), "_levels": sparse_demand.levels(F.col("y"))})
    level = lambda m: F.col(f"_levels.{m}") if m in SPARSE else F.lit(None).cast("double")
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), level(m).alias("_level")) for m in models])
    return rows.select(*[c for c in rows.columns if c != "_levels"], F.inline(pairs))


def _mean_of(terms: Column, count: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda a, v: a + v) / count


METRICS = {
    "smape": smape_term,
    "mae": lambda actual, forecast: F.abs(actual - forecast),
}


def mm_evaluate(train: DataFrame, models: Iterable[str] = tuple(MODELS), horizon: int = spec.HORIZON_MONTHS,
                backtest: int = spec.BACKTEST_MONTHS, stride: int = spec.BACKTEST_STRIDE,
                metric: str = "smape") -> DataFrame:
    """Score of every model on every series and rolling origin.

    A window whose training part is empty, or whose fit fails, scores NULL.
    """
    windows, models = backtest_windows(horizon, backtest, stride), list(models)
    size = F.size("y")
    cut = F.greatest(size - backtest + F.col("window_no") * stride, F.lit(0))
    rows = pack(train, ID, TIME, VALUE).withColumn("window_no", F.explode(F.sequence(F.lit(0), F.lit(windows - 1))))
    rows = _with_models(rows.select(
        ID, "window_no", shift_month_end("last_ym", F.col("window_no") * stride - backtest).alias("cutoff_ym"),
        F.slice("y", F.lit(1), cut).alias("y"), F.slice("y", cut + 1, F.lit(horizon)).alias("actual")), models)
    error = METRICS[metric]
    scored = predict(rows, F.lit(horizon), models)
    terms = F.zip_with("actual", "p50", lambda a, p: error(a, F.greatest(p, F.lit(0.0))))
    mean = _mean_of(terms, F.greatest(F.size("actual"), F.size("p50")))
    return scored.select(ID, "model", "window_no", "cutoff_ym", F.when(F.col("p50").isNotNull(), mean).alias("metric_value"))


def mm_score(train: DataFrame, models: Iterable[str] = tuple(MODELS), horizon: int = spec.HORIZON_MONTHS) -> DataFrame:
    """Forecast of every model for every series past its last month."""
    models = list(models)
    rows = _with_models(pack(train, ID, TIME, VALUE), models)
    return unpack(predict(rows, F.lit(horizon), models), [ID, "model"])


def conformal_forecast(train: DataFrame, model: str, horizon: int = spec.HORIZON_MONTHS,
                       origins: int = 2 * spec.HORIZON_MONTHS, level: float = 0.95) -> DataFrame:
    """Forecast of one model for every series, with bounds from its own past misses.

    The model is run from each of the last `origins` months; the absolute misses k months ahead
    are ranked, and the one at rank ceil((m + 1) * level) of m is the half-width for that step.
    No shape of the errors is assumed. A step that no origin reaches has the last known
    half-width; a series without any miss has no bounds.
    """
    packed = pack(train, ID, TIME, VALUE).withColumn("model", F.lit(model))
    size = F.size("y")
    past = packed.filter(size > 1).withColumn("origin", F.explode(F.sequence(F.lit(1), F.least(F.lit(origins), size - 1))))
    past = past.select(ID, "last_ym", "model", F.slice("y", F.lit(1), size - F.col("origin")).alias("y"),
                       F.slice("y", size - F.col("origin") + 1, F.lit(horizon)).alias("actual"))
    tried = predict(past, F.lit(horizon), [model]).filter(F.col("p50").isNotNull())
    misses = F.zip_with("actual", F.slice("p50", F.lit(1), F.size("actual")), lambda a, p: F.abs(a - F.greatest(p, F.lit(0.0))))
    ranked = tried.select(ID, F.posexplode(misses).alias("step", "miss")).groupBy(ID, "step").agg(F.array_sort(F.collect_list("miss")).alias("ranked"))
    rank = F.least(F.size("ranked"), F.ceil((F.size("ranked") + 1) * F.lit(level)).cast("int"))
    steps = ranked.select(ID, F.struct("step", F.get("ranked", rank - 1).alias("width")).alias("s")).groupBy(ID).agg(
        F.array_sort(F.collect_list("s")).alias("steps"))
    widths = steps.select(ID, F.transform("steps", lambda x: x["width"]).alias("widths"))
    ahead = predict(packed, F.lit(horizon), [model]).join(widths, ID, "left")
    rows = ahead.select(ID, "model", "last_ym", "widths", F.posexplode("p50").alias("k", "p50"))
    width = F.get("widths", F.least(F.col("k"), F.size("widths") - 1))
    return rows.select(
        ID, "model", shift_month_end("last_ym", F.col("k") + 1).alias("target_ym"), F.greatest("p50", F.lit(0.0)).alias("p50"),
        F.greatest(F.greatest("p50", F.lit(0.0)) - width, F.when(width.isNotNull(), 0.0)).alias("lower_bound"),
        (F.greatest("p50", F.lit(0.0)) + width).alias("upper_bound"))


def best_models(evaluation: DataFrame, ties: str = "keep") -> DataFrame:
    """Model with the lowest mean score per series; NULL scores do not count.

    Ties are kept by default; `ties="first"` keeps the alphabetically first winner. Mean
    scores are rounded so that the order of summation cannot break or make a tie. The
    window ranks the models of one series, as many rows as there are models.
    """
    mean = evaluation.groupBy(ID, "model").agg(F.round(F.avg("metric_value"), SCORE_DIGITS).alias("avg_metric"))
    # only now: a filter on the score itself is pushed below the forecasts and computes every one of them again, several times over
    mean = mean.filter(F.col("avg_metric").isNotNull())
    per_series = Window.partitionBy(ID).orderBy("avg_metric")
    rank = F.rank().over(per_series) if ties == "keep" else F.row_number().over(per_series.orderBy("avg_metric", "model"))
    return mean.withColumn("_rank", rank).filter(F.col("_rank") == 1).select(
        ID, "model", "avg_metric", F.lit(spec.MAIN_ROUTE).alias("forecast_source"))


def summarise_best(best: DataFrame) -> DataFrame:
    """Wins per model, by route and with the mean score where those columns are present."""
    groups = ["model"] + [c for c in ("forecast_source",) if c in best.columns]
    measures = [F.count(F.lit(1)).alias("wins")]
    if "avg_metric" in best.columns:
        measures.append(F.avg("avg_metric").alias("avg_metric"))
    return best.groupBy(*groups).agg(*measures).orderBy(F.col("wins").desc())


def evaluation_summary(best: DataFrame, items: DataFrame) -> DataFrame:
    """Which model won how many series in each demand class."""
    keyed = best.withColumn("item_code", split_series_id(ID, 0))
    rows = keyed.join(items.select("item_code", "demand_class"), "item_code")
    return rows.groupBy("demand_class", "model").agg(
        F.count(F.lit(1)).alias("series_count"), F.avg("avg_metric").alias("avg_metric"))


def routed_models(best: DataFrame, routed: DataFrame, rule: str = "naive_12") -> DataFrame:
    """The model each series will use: its best one, or `rule` where it is routed to the simple rule."""
    route = routed.select(series_id(*spec.SERIES).alias(ID), F.col("forecast_source").alias("_route"))
    simple = F.col("_route") == "simple_rule"
    both = best.select(ID, "model", "avg_metric").join(route, ID, "right")
    return both.select(
        ID, F.when(simple, F.lit(rule)).otherwise(F.coalesce("model", F.lit(rule))).alias("model"),
        F.when(~simple, F.col("avg_metric")).alias("avg_metric"), F.col("_route").alias("forecast_source"))


def on_route(df: DataFrame, routed: DataFrame, route: str) -> DataFrame:
    """The rows of the series that `demand.route_series` sends down a route."""
    return df.join(routed.filter(F.col("forecast_source") == route).select(*spec.SERIES), spec.SERIES, "left_semi")


def sparse_winners(evaluation: DataFrame, routed: DataFrame) -> DataFrame:
    """The best sparse method of each series on the separate route; without any score it is the first one."""
    best = best_models(evaluation, ties="first").select(ID, "model", "avg_metric")
    route = routed.filter(F.col("forecast_source") == spec.SEPARATE_ROUTE).select(series_id(*spec.SERIES).alias(ID), "forecast_source")
    return route.join(best, ID, "left").select(ID, F.coalesce("model", F.lit(SPARSE[0])).alias("model"), "avg_metric", "forecast_source")


def score_routed(train: DataFrame, chosen: DataFrame, horizon: int = spec.HORIZON_MONTHS) -> DataFrame:
    """Forecast of each series with the model chosen for it, recording the route."""
    rows = pack(train, ID, TIME, VALUE).join(chosen.select(ID, "model", "forecast_source"), ID)
    return unpack(predict(rows, F.lit(horizon)), [ID, "model", "forecast_source"])
