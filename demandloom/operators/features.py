"""Lag, rolling and calendar features, and the splits by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.calendar import month_number, newest_months


def calendar_features(df: DataFrame, origin_year: Column | int | None = None, time: str = "ym") -> DataFrame:
    """Month of year and running month counted from the first year of the data."""
    if origin_year is None:
        origin_year = df.select(F.min(F.year(time))).scalar()
    return df.withColumns({
        "month": F.month(time),
        "month_index": month_number(time) - origin_year * 12,
    })


def build_features(df: DataFrame, origin_year: Column | int | None = None,
                   series: list[str] = spec.SERIES, time: str = "ym", value: str = "qty") -> DataFrame:
    """The eleven model inputs, the same for training and scoring.

    Input must be gap-free per series. All row windows share one partitioning and order,
    so Spark evaluates them in a single pass over one shuffle; a window group is one
    series and so never longer than the calendar. The current month is never an input.
    """
    by_time = Window.partitionBy(*series).orderBy(time)

    def previous(n: int):
        return by_time.rowsBetween(-n, -1)

    seen = F.least(F.row_number().over(by_time), F.lit(12))
    hits = F.coalesce(F.sum((F.col(value) > 0).cast("int")).over(previous(12)), F.lit(0))
    rows = df.select(
        *series, time, value,
        *[F.lag(value, k).over(by_time).alias(f"lag_{k}") for k in (1, 2, 3, 12)],
        *[F.avg(value).over(previous(n)).alias(f"roll_mean_{n}") for n in (3, 6, 12)],
        F.stddev_samp(value).over(previous(6)).alias("roll_std_6"),
        (hits / seen).alias("nonzero_ratio_12"),
    )
    if origin_year is None:
        origin_year = df.select(F.min(F.year(time))).scalar()
    return calendar_features(rows, origin_year, time).select(*series, time, value, *spec.FEATURES)


def training_frame(features: DataFrame) -> DataFrame:
    """Rows on which every feature is known."""
    return features.dropna(subset=list(spec.FEATURES))


def temporal_split(frame: DataFrame, months: DataFrame | None = None,
                   valid_months: int = spec.VALID_MONTHS,
                   built_ago: int = spec.BUILT_MONTHS_AGO,
                   recent_months: int = spec.RECENT_MONTHS) -> DataFrame:
    """Label rows train / valid / unseen by month, and mark the newest months as recent.

    `built_ago` months are held back as not yet seen when the model was built; the
    `valid_months` before them validate. With `built_ago=0` nothing is held back.
    `months` may be any cheap relation with the same months (defaults to the frame).
    """
    newest = newest_months(frame if months is None else months, max(built_ago + valid_months, recent_months))
    as_of, first_valid = F.get(newest, built_ago), F.get(newest, built_ago + valid_months - 1)
    split = (
        F.when(F.col("ym") > as_of, "unseen").when(F.col("ym") >= first_valid, "valid").otherwise("train")
    )
    return frame.withColumns({
        "split": split,
        "is_recent": F.col("ym") >= F.get(newest, recent_months - 1),
    })


def split_counts(split: DataFrame) -> DataFrame:
    """Rows, series and months of each part of a split."""
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(*spec.SERIES).alias("series"),
        F.min("ym").alias("first_ym"), F.max("ym").alias("last_ym"), F.count_if("is_recent").alias("n_recent"))
