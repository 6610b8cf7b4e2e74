"""Column expressions on series identifiers, forecasts and errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator of a composite series id and the pattern that splits it.
SEPARATOR = "|"
SEPARATOR_CLASS = "[|]"


def series_id(*parts: str) -> Column:
    return F.concat_ws(SEPARATOR, *parts)


def split_series_id(column: Column | str, position: int) -> Column:
    return F.split(column, SEPARATOR_CLASS)[position]


def half_up(value: Column) -> Column:
    """Nearest whole number, halves upwards."""
    return F.floor(value + 0.5)


def clip0(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.greatest(value, F.lit(0.0))


def ratio_interval(p50: Column, ratios: tuple[float, float], whole: bool = False) -> tuple[Column, Column]:
    """Bounds as fixed fractions of the forecast, optionally rounded to whole units."""
    low, high = p50 * ratios[0], p50 * ratios[1]
    if whole:
        low, high = half_up(low).cast("double"), half_up(high).cast("double")
    return low, high


def abs_error(actual: Column, forecast: Column) -> Column:
    return F.abs(actual - forecast)


def ape(actual: Column, forecast: Column) -> Column:
    """Absolute error as a share of the actual; undefined when nothing was shipped."""
    return F.when(actual > 0, abs_error(actual, forecast) / actual)


def within(actual: Column, lower: Column, upper: Column) -> Column:
    """1 when the actual lies inside the interval, ends included; missing bounds count as a miss."""
    return F.when(actual.between(lower, upper), 1).otherwise(0)


def smape_term(actual: Column, forecast: Column) -> Column:
    """Symmetric error of one point; a perfect zero counts as no error."""
    size = F.abs(actual) + F.abs(forecast)
    return F.when(size == 0, F.lit(0.0)).otherwise(2 * F.abs(actual - forecast) / size)


def share_of(part: Column, whole: Column) -> Column:
    """Ratio that is NULL instead of an error when the divisor is zero."""
    return F.try_divide(part, whole)
