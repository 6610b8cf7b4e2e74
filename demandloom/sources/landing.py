"""Landing files: load sets, user files in untidy shape, and what became of their rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions.calendar import parse_year_month


def split_load_set(df: DataFrame, holdout: str | Column, load_set: str = "all", month: str = "ym") -> DataFrame:
    """Months before the hold-out ("A"), the hold-out itself ("B") or everything ("all")."""
    day = holdout if isinstance(holdout, Column) else F.lit(holdout).cast("date")
    if load_set == "all":
        return df
    if load_set not in ("A", "B"):
        raise ValueError(f"load set must be A, B or all, not {load_set!r}")
    return df.filter(F.col(month) < day if load_set == "A" else F.col(month) == day)


def write_landing(df: DataFrame, folder: str) -> None:
    """Add CSV files with a header to a landing folder; what is there already stays."""
    df.write.mode("append").option("header", True).csv(folder)


# How each kind of untidy column is written.
MONTH_PATTERN = "yyyy年M月"
KINDS = ("text", "month", "number")


def _typed(column: Column, kind: str) -> Column:
    if kind == "month":
        return parse_year_month(F.trim(column), MONTH_PATTERN)
    if kind == "number":
        return F.replace(F.trim(column), F.lit(","), F.lit("")).try_cast("bigint")
    return column


def tidy(raw: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Typed columns from text ones: {header: (name, kind)}.

    A value that does not convert becomes NULL; the row stays, its text in `<name>_raw`.
    """
    for header, (_, kind) in mapping.items():
        if kind not in KINDS:
            raise ValueError(f"{header}: kind must be one of {KINDS}, not {kind!r}")
    columns = []
    for header, (name, kind) in mapping.items():
        text = F.col(f"`{header}`")
        columns.append(_typed(text, kind).alias(name))
        if kind != "text":
            columns.append(text.alias(f"{name}_raw"))
    return raw.select(*columns)


def ingest_messy(spark: SparkSession, path: str, mapping: Mapping[str, tuple[str, str]],
                 encoding: str = "UTF-8") -> DataFrame:
    """Read a user CSV as text and tidy it.

    Encodings outside Spark's own list (Shift_JIS among them) need
    `spark.sql.legacy.javaCharsets` to be set on the session.
    """
    raw = spark.read.option("header", True).option("encoding", encoding).csv(path)
    return tidy(raw, mapping)


def ingest_report(tidied: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows received, rows with a value that did not convert, and rows beyond the first of a key.

    Grouping by key first brings any number of copies of one key down to one row per map
    task before the shuffle; the totals come from those.
    """
    raws = [c for c in tidied.columns if c.endswith("_raw")]
    bad = F.lit(False)
    for c in raws:
        bad = bad | (F.col(c).isNotNull() & F.col(c.removesuffix("_raw")).isNull())
    per_key = tidied.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(bad).alias("_bad"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("rows_failed"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
    )
