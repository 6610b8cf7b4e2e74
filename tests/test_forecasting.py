"""Local forecasters against known answers, and the grouped and many-model operators."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from demandloom.functions import forecasters as fc
from demandloom.operators import forecasting
from test_operators import month_ends, ship

RNG = np.random.default_rng(7)
WAVE = 50 + 20 * np.sin(2 * np.pi * np.arange(72) / 12)


def croston_by_hand(y, alpha=0.1):
    """Textbook recursion, one series at a time."""
    size = gap = None
    since = 1
    for i, v in enumerate(y):
        if v > 0:
            if size is None:
                size, gap = float(v), float(i + 1)
            else:
                size += alpha * (v - size)
                gap += alpha * (since - gap)
            since = 1
        else:
            since += 1
    return 0.0 if size is None else (1 - alpha / 2) * size / gap


def test_croston_matches_the_recursion():
    y = np.where(RNG.random((20, 60)) < 0.3, RNG.integers(1, 20, (20, 60)), 0)
    y[0] = 0
    mean, _sd = fc.croston_sba(y, 4)
    for row, values in zip(mean, y):
        assert row == pytest.approx([croston_by_hand(values)] * 4)


def test_smoothing_matches_the_recursion():
    y = RNG.poisson(8, 40).astype(float)
    best = None
    for alpha in (0.05, 0.1, 0.2, 0.3, 0.5, 0.8):
        level, errors = y[0], []
        for v in y[1:]:
            errors.append(v - level)
            level += alpha * errors[-1]
        sse = sum(e * e for e in errors)
        if best is None or sse < best[0]:
            best = sse, level, alpha, np.std(errors, ddof=1)
    level, alpha, sd = fc._smooth(y[None, :])
    assert (level[0], alpha[0], sd[0, 0]) == pytest.approx(best[1:])


def test_autoregression_matches_least_squares():
    y = RNG.normal(50, 5, 60)
    design = np.column_stack([np.ones(58), y[1:-1], y[:-2]])
    beta = np.linalg.lstsq(design, y[2:], rcond=None)[0]
    mean, residual, _aic = fc._autoregress(y[None, :], 2, 2)
    first = beta @ [1, y[-1], y[-2]]
    assert mean[0] == pytest.approx([first, beta @ [1, first, y[-1]]], rel=1e-4)
    assert residual[0] == pytest.approx(y[2:] - design @ beta, abs=1e-3)


def test_seasonal_naive_repeats_last_year():
    y = np.arange(36.0)[None, :]
    mean, sd = fc.seasonal_naive(y, 18)
    assert list(mean[0]) == [24 + k % 12 for k in range(18)] and (sd == 0).all()


@pytest.mark.parametrize("name", ["ets", "theta", "auto_ar", "mfles", "fourier_trend", "auto"])
def test_a_clean_season_is_recovered(name):
    mean, sd = fc.FITTED[name](WAVE[None, :60], 12)
    assert np.abs(mean[0] - WAVE[60:]).max() < 3.0
    assert np.isfinite(sd).all() and (sd >= 0).all()


@pytest.mark.parametrize("name", ["theta", "auto_ar", "mfles", "fourier_trend"])
def test_a_trend_is_followed(name):
    y = 10 + 2.0 * np.arange(60)
    mean, _sd = fc.FITTED[name](y[None, :], 6)
    assert (mean[0] > y[-1] - 6).all() and mean[0, -1] > mean[0, 0]


@pytest.mark.parametrize("name", sorted(fc.FITTED))
@pytest.mark.parametrize("months", [1, 2, 5, 13, 24, 31])
def test_zero_series_stay_finite_and_short_ones_are_not_fitted(name, months):
    y = np.vstack([np.zeros(months), RNG.integers(0, 9, months), np.full(months, 4.0)])
    mean, sd = fc.FITTED[name](y, 5)
    assert mean.shape == sd.shape == (3, 5)
    if months < fc.LEAST.get(name, 1):
        assert np.isnan(mean).all() and np.isnan(sd).all(), "no other method under this name"
    else:
        assert np.isfinite(mean).all() and np.isfinite(sd).all()


@pytest.mark.parametrize("name", sorted(fc.FITTED))
def test_a_block_equals_its_rows(name):
    y = RNG.poisson(5, (6, 48)).astype(float)
    mean, sd = fc.FITTED[name](y, 6)
    for i in range(len(y)):
        alone, alone_sd = fc.FITTED[name](y[i:i + 1], 6)
        assert mean[i] == pytest.approx(alone[0]) and sd[i] == pytest.approx(alone_sd[0])


def test_grouped_forecast_ends_at_the_given_date(spark):
    base = ship(spark, {("A", "DOM"): [int(v) for v in WAVE[:36]], ("B", "EXP"): [3] * 30})
    df = base.select(F.concat_ws("|", "item_code", "channel").alias("g"), "ym", "qty")
    out = forecasting.forecast_by_group(df, "2023-03-31", "ym", "qty", "g")
    assert out.columns == ["g", "ym", "qty_forecast", "qty_lower", "qty_upper"]
    ends = month_ends(dt.date(2020, 1, 31), 39)
    got = {(r["g"], r["ym"]): r for r in out.collect()}
    assert {ym for g, ym in got if g == "A|DOM"} == set(ends[36:39])
    assert {ym for g, ym in got if g == "B|EXP"} == set(ends[30:39])
    assert all(r["qty_lower"] <= r["qty_forecast"] <= r["qty_upper"] and r["qty_lower"] >= 0 for r in got.values())
    assert got["B|EXP", ends[30]]["qty_forecast"] == pytest.approx(3.0)
    assert forecasting.forecast_by_group(df, "2022-06-30", "ym", "qty", "g").count() == 0
    with pytest.raises(ValueError, match="ME"):
        forecasting.forecast_by_group(df, "2023-03-31", "ym", "qty", "g", frequency="M")
    with pytest.raises(ValueError, match="unknown model"):
        forecasting.forecast_by_group(df, "2023-03-31", "ym", "qty", "g", model="oracle")


def test_holdout_never_sees_the_hidden_year(spark):
    calm, wild = [5] * 36, [5] * 24 + [500] * 12
    out = forecasting.backtest_holdout(ship(spark, {("A", "DOM"): calm, ("B", "DOM"): wild}))
    got = rows(out.select("item_code", "target_ym", "p50", "forecast_run_ym"), "item_code", "target_ym")
    assert len(got) == 24 and {g[3] for g in got} == {dt.date(2021, 12, 31)}
    assert all(g[2] == pytest.approx(5.0) for g in got)


def test_windows():
    assert forecasting.backtest_windows(18, 24, 6) == 2
    assert forecasting.backtest_windows(18, 30, 6) == 3
    assert forecasting.backtest_windows(18, 18, 6) == 1
    with pytest.raises(ValueError, match="shorter"):
        forecasting.backtest_windows(18, 12, 6)


def test_evaluation_scores_every_model_and_window(spark):
    train = forecasting.mm_train(ship(spark, {("A", "DOM"): [round(v) for v in WAVE], ("B", "DOM"): [0] * 72}))
    late = ship(spark, {("C", "DOM"): [2] * 20}, first=dt.date(2024, 5, 31))
    train = train.unionByName(forecasting.mm_train(late))
    out = forecasting.mm_evaluate(train, ["ets", "naive_12", "zero", "no_such_model"])
    got = {(r["unique_id"], r["model"], r["window_no"]): r["metric_value"] for r in out.collect()}
    assert len(got) == 3 * 4 * 2
    assert got["C|DOM", "ets", 0] is None and got["C|DOM", "naive_12", 0] is None, "nothing to train on"
    assert got["C|DOM", "naive_12", 1] == 0.0, "two months to train on"
    assert got["C|DOM", "ets", 1] is None, "too few for this method"
    assert got["A|DOM", "naive_12", 0] == pytest.approx(0.0) and got["A|DOM", "zero", 1] == pytest.approx(2.0)
    assert got["B|DOM", "zero", 0] == 0.0 and got["A|DOM", "no_such_model", 0] is None
    cutoffs = {r["window_no"]: r["cutoff_ym"] for r in out.collect()}
    assert cutoffs == {0: dt.date(2023, 12, 31), 1: dt.date(2024, 6, 30)}
    assert dict(rows(forecasting.best_models(out, "first").select("unique_id", "model")))["A|DOM"] == "naive_12"


def test_ties_and_missing_scores(spark):
    evaluation = spark.createDataFrame(
        [("s", "b", 0.5), ("s", "a", 0.4), ("s", "a", 0.6), ("s", "c", 0.9), ("s", "d", None), ("t", "d", None)],
        "unique_id STRING, model STRING, metric_value DOUBLE")
    assert [r[1] for r in rows(forecasting.best_models(evaluation))] == ["a", "b"]
    assert [r[1] for r in rows(forecasting.best_models(evaluation, ties="first"))] == ["a"]
    best = forecasting.best_models(evaluation)
    assert rows(forecasting.summarise_best(best.drop("avg_metric", "forecast_source"))) == [("a", 1), ("b", 1)]


def test_routing_replaces_hard_series(spark):
    best = spark.createDataFrame([("A|DOM", "ets", 0.2), ("B|DOM", "theta", 0.3)], "unique_id STRING, model STRING, avg_metric DOUBLE")
    routed = spark.createDataFrame(
        [("A", "DOM", "main_pipeline"), ("B", "DOM", "simple_rule"), ("C", "DOM", "main_pipeline")],
        "item_code STRING, channel STRING, forecast_source STRING")
    chosen = forecasting.routed_models(best, routed)
    assert rows(chosen) == [("A|DOM", "ets", 0.2, "main_pipeline"), ("B|DOM", "naive_12", None, "simple_rule"),
                            ("C|DOM", "naive_12", None, "main_pipeline")]
    train = forecasting.mm_train(ship(spark, {("A", "DOM"): [4] * 36, ("B", "DOM"): list(range(36)), ("C", "DOM"): [1] * 36}))
    out = forecasting.score_routed(train, chosen, horizon=3)
    assert out.count() == 9
    assert [r["p50"] for r in out.filter("unique_id = 'B|DOM'").orderBy("target_ym").collect()] == [24.0, 25.0, 26.0]


def test_fits_use_all_partitions(spark):
    train = forecasting.mm_train(ship(spark, {(f"I{i}", "DOM"): [i] * 24 for i in range(40)}))
    out = forecasting.mm_score(train, ["ets"], horizon=2)
    assert out.select(F.spark_partition_id()).distinct().count() > 1


def test_bounds_from_past_misses_cover_what_comes(spark):
    rng = np.random.default_rng(12)
    months = [dt.date(2015 + k // 12, k % 12 + 1, 28) for k in range(96)]
    data = {f"S{i}|DOM": rng.gamma(4.0, 10.0 + i % 7, 96) for i in range(150)}
    lines = [(k, m, float(v)) for k, y in data.items() for m, v in zip(months[:78], y)]
    train = spark.createDataFrame(lines, "unique_id STRING, ds DATE, y DOUBLE").withColumn("ds", F.last_day("ds"))
    for model in ("mean_12", "theta"):
        got = forecasting.conformal_forecast(train, model).collect()
        assert len(got) == 150 * 18
        inside = []
        for r in got:
            k = (r["target_ym"].year - 2015) * 12 + r["target_ym"].month - 1
            inside.append(r["lower_bound"] <= data[r["unique_id"]][k] <= r["upper_bound"])
        assert 0.90 <= np.mean(inside) <= 0.98
    short = spark.createDataFrame([("S|D", dt.date(2024, 1, 31), 5.0)], "unique_id STRING, ds DATE, y DOUBLE")
    assert {(r["p50"], r["lower_bound"], r["upper_bound"]) for r in forecasting.conformal_forecast(short, "mean_12").collect()} == {(5.0, None, None)}
