"""Cleaned relations: month ends, one row per key, rule counts. Always rebuilt in full."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.calendar import month_end
from demandloom.operators.dedup import latest_by

LINEAGE = ("_ingested_at", "_source_file")


def clean(bronze: DataFrame, feed: str) -> DataFrame:
    """Newest ingestion per natural key after moving every month column to its month end."""
    source = spec.SOURCES[feed]
    aligned = bronze.select(
        *[month_end(c).alias(c) if c in source.months else F.col(c) for c in source.columns], *LINEAGE
    )
    newest = latest_by(aligned, list(source.key), list(LINEAGE))
    kept = [*source.columns, "_source_file", "_ingested_at"] if feed == "shipments" else source.columns
    return newest.select(*kept)
