"""Window features against a plain restatement, and the splits by time."""

from __future__ import annotations

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import rows
from demandloom import spec
from demandloom.operators import features
from test_operators import month_ends, ship

VALUES = [0, 3, 0, 0, 5, 1, 0, 2, 0, 0, 4, 0, 7, 0, 1]


def restated(values: list[int], k: int) -> dict:
    past = values[:k]
    six = past[-6:]
    return {
        **{f"lag_{n}": values[k - n] if k >= n else None for n in (1, 2, 3, 12)},
        **{f"roll_mean_{n}": sum(past[-n:]) / len(past[-n:]) if past else None for n in (3, 6, 12)},
        "roll_std_6": statistics.stdev(six) if len(six) > 1 else None,
        "nonzero_ratio_12": sum(v > 0 for v in past[-12:]) / min(k + 1, 12),
    }


def test_features_follow_their_definition(spark):
    reverse = VALUES[::-1]
    df = features.build_features(ship(spark, {("A", "DOM"): VALUES, ("A", "EXP"): reverse}).repartition(3))
    got = {(r["channel"], r["ym"]): r for r in df.collect()}
    for channel, values in (("DOM", VALUES), ("EXP", reverse)):
        for k, ym in enumerate(month_ends(dt.date(2020, 1, 31), len(values))):
            row = got[channel, ym]
            for name, expected in restated(values, k).items():
                assert row[name] == (pytest.approx(expected) if expected is not None else None), (name, k)
            assert row["month"] == ym.month and row["month_index"] == k + 1
    first = [got["DOM", ym]["nonzero_ratio_12"] for ym in month_ends(dt.date(2020, 1, 31), 4)]
    assert first == pytest.approx([0.0, 0.0, 1 / 3, 0.25])


def test_training_frame_drops_the_first_year(spark):
    df = features.build_features(ship(spark, {("A", "DOM"): VALUES}))
    assert features.training_frame(df).count() == len(VALUES) - 12


def test_split_is_disjoint_and_complete(spark):
    base = ship(spark, {("A", "DOM"): list(range(40)), ("B", "DOM"): list(range(40))})
    frame = features.training_frame(features.build_features(base))
    split = features.temporal_split(frame, base)
    ends = month_ends(dt.date(2020, 1, 31), 40)
    counts = {r["split"]: r for r in features.split_counts(split).collect()}
    assert sum(r["n"] for r in counts.values()) == frame.count()
    assert (counts["unseen"]["first_ym"], counts["unseen"]["last_ym"]) == (ends[34], ends[39])
    assert (counts["valid"]["first_ym"], counts["valid"]["last_ym"]) == (ends[22], ends[33])
    assert counts["train"]["last_ym"] == ends[21] and counts["unseen"]["n_recent"] == 6
    newest = features.temporal_split(frame, base, built_ago=0)
    assert {r[0] for r in newest.select("split").distinct().collect()} == {"train", "valid"}
    assert rows(newest.filter("split = 'valid'").select(F.min("ym"))) == [(ends[28],)]


def test_one_shuffle_for_all_windows(spark):
    df = features.build_features(ship(spark, {("A", "DOM"): VALUES}), origin_year=2020)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert set(spec.FEATURES) <= set(df.columns)
