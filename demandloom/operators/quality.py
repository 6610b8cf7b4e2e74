"""Data-quality rules that count and keep, and tolerance checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom import spec

# The rules of each cleaned relation.
RULES: dict[str, dict[str, str]] = {
    "shipments": {
        "item_code_not_null": "item_code IS NOT NULL",
        "channel_is_known": "channel IN ('DOM', 'EXP')",
        "ym_not_null": "ym IS NOT NULL",
        "qty_not_negative": "qty >= 0",
    },
    "items": {
        "item_code_not_null": "item_code IS NOT NULL",
        "demand_class_is_known":
            "demand_class IN ('smooth', 'erratic', 'intermittent', 'lumpy', 'lumpy_severe')",
    },
    "inventory": {"closing_qty_not_negative": "closing_qty >= 0"},
}


def _tally(rules: dict[str, str]) -> list[Column]:
    """Per rule one struct (passed, failed, unknown); a NULL verdict is unknown, not a failure."""
    out = []
    for name, rule in rules.items():
        verdict = F.expr(rule)
        out.append(F.struct(
            F.count_if(verdict).alias("passed"),
            F.count_if(~verdict).alias("failed"),
            F.count_if(verdict.isNull()).alias("unknown"),
        ).alias(name))
    return out


def quality_counts(df: DataFrame, relation: str, rules: dict[str, str] | None = None) -> DataFrame:
    """One row per rule, from a single aggregation over the relation."""
    rules = RULES[relation] if rules is None else rules
    tallies = df.agg(*_tally(rules))
    rows = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name)["passed"].alias("passed"),
                 F.col(name)["failed"].alias("failed"), F.col(name)["unknown"].alias("unknown"))
        for name in rules
    ])
    return tallies.select(F.explode(rows).alias("_r")).select(F.lit(relation).alias("relation"), "_r.*")


def observe_quality(df: DataFrame, relation: str, observation) -> DataFrame:
    """The relation unchanged, with its rule counts collected while it is being written."""
    metrics = []
    for name, rule in RULES[relation].items():
        verdict = F.expr(rule)
        metrics += [F.count_if(verdict).alias(f"{name}_passed"),
                    F.count_if(~verdict).alias(f"{name}_failed"),
                    F.count_if(verdict.isNull()).alias(f"{name}_unknown")]
    return df.observe(observation, *metrics)


def within_tolerance(actual: Column, target: Column, tolerance: float) -> Column:
    """Relative deviation inside the tolerance; a zero target asks for an exact zero."""
    return F.when(target == 0, actual == 0).otherwise(F.abs(actual - target) / F.abs(target) <= tolerance)


def tolerance_check(measured: DataFrame, targets: DataFrame, key: str = "item_code") -> DataFrame:
    """Measured statistics next to their targets, with a verdict per statistic and overall."""
    names = list(spec.TOLERANCE)
    left = targets.select(key, *[F.col(n).alias(f"target_{n}") for n in names])
    right = measured.select(key, *[F.col(n).alias(f"actual_{n}") for n in names])
    both = left.join(right, key)
    checks = {
        f"{n}_ok": within_tolerance(F.col(f"actual_{n}"), F.col(f"target_{n}"), tol)
        for n, tol in spec.TOLERANCE.items()
    }
    verdict = both.withColumns(checks)
    return verdict.withColumn("all_ok", F.col("adi_ok") & F.col("cv2_ok") & F.col("mean_qty_ok"))
