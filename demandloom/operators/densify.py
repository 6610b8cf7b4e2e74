"""Gap filling of monthly series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.calendar import month_number, shift_month_end


def densify(df: DataFrame, series: list[str], time: str, values: str | list[str],
            start: Column, end: Column) -> DataFrame:
    """One row per series and month from `start` to `end`; months without a row become 0.

    Each row emits itself and the zero months up to the next row of its series, so the
    whole calendar appears without building series x months and joining back. It takes a
    single shuffle on the series, which later windows and groupings on the series reuse.
    Months and values come out of a generator rather than a projection, since Spark moves a
    later semi-join on the series in front of generators: there are no zero months yet.
    """
    values = [values] if isinstance(values, str) else values
    by_time = Window.partitionBy(*series).orderBy(time)
    begin = F.when(F.lag(time).over(by_time).isNull(), start).otherwise(F.col(time))
    stop = F.coalesce(month_number(F.lead(time).over(by_time)), month_number(end) + 1)
    rows = df.select(*series, time, *values, begin.alias("_from"), stop.alias("_stop"))
    rows = rows.select(
        *series, *values, "_from", (month_number(time) - month_number("_from")).alias("_own"),
        F.sequence(F.lit(0), F.col("_stop") - month_number("_from") - 1).alias("_steps"))
    gaps = rows.select(*series, *values, "_from", "_own", F.explode("_steps").alias("_k"))

    def or_zero(value: str) -> Column:
        zero = F.lit(0).cast(df.schema[value].dataType)
        return F.when(F.col("_k") == F.col("_own"), F.col(value)).otherwise(zero).alias(value)

    month = F.struct(shift_month_end("_from", F.col("_k")).alias(time), *[or_zero(v) for v in values])
    return gaps.select(*series, F.inline(F.array(month)))
