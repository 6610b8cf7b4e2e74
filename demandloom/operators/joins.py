"""Fact-to-dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Many-to-one join of a fact to a dimension.

    No broadcast hint: the dimension grows with the assortment, so the size check is left
    to `autoBroadcastJoinThreshold` on the measured size, and beyond it a shuffled join is
    used whose hot keys the adaptive skew join splits.
    """
    return fact.join(dim, on, how)
