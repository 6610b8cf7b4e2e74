"""Month arithmetic. Every month is held as the DATE of its last day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_end(day: Column | str) -> Column:
    """Last day of the month `day` falls in."""
    return F.last_day(day)


def shift_month_end(month: Column | str, months: int | Column) -> Column:
    """Month end `months` later; re-aligned because adding months keeps the day of month."""
    return F.last_day(F.add_months(month, months))


def month_number(month: Column | str) -> Column:
    """Running month count, so that consecutive months differ by one."""
    return F.year(month) * 12 + F.month(month)


def parse_year_month(text: Column | str, pattern: str = "yyyy-MM") -> Column:
    """Month end of a textual year and month, NULL where the text does not parse."""
    return F.last_day(F.to_date(F.try_to_timestamp(text, F.lit(pattern))))


def latest(df: DataFrame, month: str = "ym") -> Column:
    """Newest month of a relation as a scalar sub-query."""
    return df.select(F.max(month)).scalar()


def earliest(df: DataFrame, month: str = "ym") -> Column:
    return df.select(F.min(month)).scalar()


def newest_months(df: DataFrame, n: int, month: str = "ym") -> Column:
    """The `n` newest distinct months, newest first, as one scalar sub-query.

    The distinct months of a monthly relation are few, and the sort keeps only `n` of them.
    """
    newest = df.select(month).distinct().orderBy(F.col(month).desc()).limit(n)
    return newest.select(F.sort_array(F.collect_list(month), asc=False)).scalar()


def nth_latest(df: DataFrame, n: int, month: str = "ym") -> Column:
    """The n-th newest distinct month (1 = newest), NULL when there are fewer."""
    return F.get(newest_months(df, n, month), n - 1)


def forecast_run_month(run_date: str) -> Column:
    """Month end of the day a forecast is made."""
    return F.last_day(F.lit(run_date).cast("date"))
