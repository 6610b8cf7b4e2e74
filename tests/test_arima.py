"""Seasonal ARIMA and the methods for series with few demands, on simulated series and against plain loops."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions import arima
from demandloom.operators import demand, forecasting, sparse_demand


def simulated(n, rows, phi=0.0, theta=0.0, year_theta=0.0, d=1, seasonal=0, seed=5):
    """(p, d, q)(0, D, 1) series of unit shocks, the first months dropped."""
    e = np.random.default_rng(seed).normal(size=(rows, n + 60))
    w = np.zeros_like(e)
    for t in range(13, n + 60):
        w[:, t] = phi * w[:, t - 1] + e[:, t] + theta * e[:, t - 1] + year_theta * (e[:, t - 12] + theta * e[:, t - 13])
    y = np.cumsum(w[:, 60:], axis=1) if d else w[:, 60:]
    if seasonal:
        for t in range(12, n):
            y[:, t] += y[:, t - 12]
    return y


def test_coefficients_of_arima_1_1_1():
    out = arima.arima(simulated(400, 40, 0.6, 0.4), 3, orders=[(1, 1, 0, 0)], given=(1, 0))
    phi, theta = (np.array([c[k][0] for c in out.coefficients]) for k in (0, 1))
    assert abs(phi.mean() - 0.6) < 0.03 and abs(theta.mean() - 0.4) < 0.03
    assert np.abs(phi - 0.6).max() < 0.2 and np.abs(theta - 0.4).max() < 0.25


def test_coefficients_of_the_seasonal_0_1_1():
    out = arima.arima(simulated(300, 40, 0.0, -0.4, -0.6, seasonal=1), 3, orders=[(0, 1, 0, 1)], given=(1, 1))
    theta, year = (np.array([c[k][0] for c in out.coefficients]) for k in (1, 3))
    assert abs(theta.mean() + 0.4) < 0.05 and abs(year.mean() + 0.6) < 0.06


def test_coefficients_with_gauss_newton_fit_no_worse_than_a_grid():
    y = simulated(120, 6, 0.5, 0.3, seed=9)
    w = np.diff(y, axis=1)
    fit = arima.fit_order(w, (1, 1, 0, 0), True, 1)
    squares = (fit.shocks[:, 1:] ** 2).sum(axis=1)
    grid = np.linspace(-0.95, 0.95, 39)
    none = np.zeros((len(y), 0))
    best = np.full(len(y), np.inf)
    for p in grid:
        for q in grid:
            e = arima.residuals(w - w.mean(axis=1, keepdims=True), np.full((len(y), 1), p), np.full((len(y), 1), q), none, none)
            best = np.minimum(best, (e[:, 1:] ** 2).sum(axis=1))
    assert (squares <= best * 1.0001).all()


def test_differences():
    walk = np.cumsum(np.random.default_rng(1).normal(size=(200, 96)), axis=1)
    twice = np.cumsum(walk, axis=1)
    noise = np.random.default_rng(2).normal(size=(200, 96))
    year = noise.copy()
    for t in range(12, 96):
        year[:, t] += year[:, t - 12]
    share = {name: [np.mean(x) for x in arima.differences(y)] for name, y in (("walk", walk), ("twice", twice), ("noise", noise), ("year", year))}
    assert 0.8 < share["walk"][0] < 1.3 and share["walk"][1] < 0.1
    assert share["twice"][0] > 1.4 and share["noise"][0] < 0.15 and share["noise"][1] < 0.1
    assert share["year"][1] > 0.85
    assert [x.tolist() for x in arima.differences(np.full((1, 60), 3.0))] == [[0], [0]]


@pytest.mark.parametrize("years", [5, 10, 30])
def test_the_seasonal_cut_is_the_five_percent_point(years):
    t = arima.seasonal_t(simulated(12 * years, 3000, seasonal=1, seed=years))
    assert 0.025 < np.mean(t < arima.SEASONAL_CUT) < 0.08


def test_order_by_criterion():
    out = arima.arima(simulated(240, 60, 0.7, 0.0, d=0), 3, given=(0, 0))
    assert np.mean([tuple(o[:2]) == (1, 0) for o in out.orders]) > 0.5
    assert np.mean(out.orders[:, 0] + out.orders[:, 1] == 0) < 0.02


def test_forecast_of_fixed_coefficients_is_the_plain_recursion():
    y = np.random.default_rng(4).gamma(2.0, 10.0, (3, 40))
    mean, sd = arima.fixed_airline(y, 15, -0.3, -0.5)
    for i in range(3):
        path, shocks = list(y[i]), [0.0] * 13
        for t in range(13, 55):
            f = path[t - 1] + path[t - 12] - path[t - 13] - 0.3 * shocks[t - 1] - 0.5 * shocks[t - 12] + 0.15 * shocks[t - 13]
            shocks.append(path[t] - f if t < 40 else 0.0)
            if t >= 40:
                path.append(f)
        assert mean[i] == pytest.approx(path[40:])
    assert (np.diff(sd, axis=1) > 0).all() and sd[:, 1] == pytest.approx(sd[:, 0] * np.sqrt(1 + 0.7 ** 2))


def test_intervals_cover_what_comes():
    y = simulated(200, 300, 0.5, 0.3, seed=11)
    out = arima.arima(y[:, :188], 12, orders=[(1, 1, 0, 0), (0, 1, 0, 0)], given=(1, 0))
    inside = np.abs(y[:, 188:] - out.mean) <= 1.96 * out.sd
    assert 0.9 < inside.mean() < 0.98


# --- few demands --------------------------------------------------------------

SERIES = {
    "rare": [0, 0, 5, 0, 0, 0, 3, 0, 0, 8, 0, 0, 0, 0, 2, 0, 0, 4], "never": [0] * 9, "once": [0, 0, 7, 0, 0], "one": [3], "zero": [0],
    "often": [4, 5, 6, 0, 3, 4, 4], "late": [0] * 10 + [9], "none": []}


def by_hand(y):
    if not y:
        return {"tsb": None, "adida": None, "imapa": None}

    def smooth(x, w=0.2):
        level = x[0]
        for v in x[1:]:
            level += w * (v - level)
        return level

    def spread(k):
        whole = len(y) // k
        start = len(y) - whole * k
        return smooth([sum(y[start + i * k:start + (i + 1) * k]) for i in range(whole)]) / k

    hits = [v for v in y if v > 0]
    size, chance = (hits[0] if hits else 0.0), len(hits) / len(y)
    for v in y:
        size += 0.2 * (v - size) if v > 0 else 0.0
        chance += 0.1 * ((v > 0) - chance)
    interval = int(len(y) / len(hits) + 0.5) if hits else len(y)
    interval = max(1, min(interval, len(y) // 2))
    return {"tsb": size * chance, "adida": spread(interval), "imapa": sum(spread(k) for k in range(1, interval + 1)) / interval}


def test_sparse_methods_equal_plain_loops(spark):
    df = spark.createDataFrame([(k, [float(v) for v in y]) for k, y in SERIES.items()], "id STRING, y ARRAY<DOUBLE>")
    got = df.select("id", *[f(F.col("y")).alias(n) for n, f in sparse_demand.METHODS.items()]).collect()
    for r in got:
        for name, value in by_hand(SERIES[r["id"]]).items():
            assert r[name] == (None if value is None else pytest.approx(value)), (r["id"], name)


def test_policy_c_has_a_run_of_its_own(spark, database, folder):
    from demandloom.streaming import cycle
    from test_operators import ship

    lumpy = [0, 0, 0, 9, 0, 0, 0, 0, 25, 0, 0, 1] * 5
    data = ship(spark, {("S", "DOM"): [10 + k % 3 for k in range(60)], ("L", "DOM"): lumpy, ("L", "EXP"): lumpy[::-1]})
    ws = cycle.Workspace(spark, database, f"{folder}/landing", f"{folder}/shared")
    items = spark.createDataFrame([("S", "smooth"), ("L", "lumpy")], "item_code STRING, demand_class STRING")
    gold = type("Facts", (), {"fct_shipments": data, "dim_item": items})
    cycle.many_models(ws, gold, models=("theta",), policy="C")
    table = lambda name: {r["unique_id"] for r in spark.table(f"{database}.{name}").collect()}
    assert table("scm_routed_forecasts") == table("scm_best_models") == {"S|DOM"}
    assert table("sparse_forecasts") == table("sparse_best_models") == table("sparse_evaluation_output") == {"L|DOM", "L|EXP"}
    chosen = {r["model"] for r in spark.table(f"{database}.sparse_best_models").collect()}
    assert chosen <= set(forecasting.SPARSE)
    counts = spark.table(f"{database}.sparse_forecasts").groupBy("unique_id", "forecast_source").count().collect()
    assert {tuple(r) for r in counts} == {("L|DOM", "separate_pipeline", 18), ("L|EXP", "separate_pipeline", 18)}
    routed = demand.route_series(demand.classify(data, spec.SERIES), "A").select("forecast_source").distinct().collect()
    assert [r[0] for r in routed] == [spec.MAIN_ROUTE]


# F1: winners are picked from scores that are worked out once

NULLS = {"early": [None, 5, 0, 3, 0, 0, 2, 0], "late": [0, 4, 0, 0, 6, 0, 0, None], "twice": [0, None, None, 4, 0, 0, 2, 0, 0], "all": [None] * 5,
         "some": [0, 0, 3, None, 0, 0, 0, 5, 0, 0, 0, 2, 0]}


def by_hand_with_nulls(y):
    """As `by_hand`, where NULL months are no demand, make a period unknown and let smoothing start anew."""
    hits, n = [v for v in y if v is not None and v > 0], len(y)

    def spread(k):
        level, start = None, n - n // k * k
        for i in range(start, n, k):
            total = None if None in y[i:i + k] else sum(y[i:i + k])
            level = total if level is None or total is None else level + 0.2 * (total - level)
        return None if level is None else level / k

    size, chance = (hits[0] if hits else 0.0), len(hits) / n
    for v in y:
        hit = v is not None and v > 0
        size += 0.2 * (v - size) if hit else 0.0
        chance += 0.1 * (hit - chance)
    interval = max(1, min(int(n / len(hits) + 0.5) if hits else n, n // 2))
    levels = [spread(k) for k in range(1, interval + 1)]
    return {"tsb": size * chance, "adida": levels[-1], "imapa": None if None in levels else sum(levels) / interval}


def test_sparse_methods_with_null_months(spark):
    df = spark.createDataFrame([(k, [None if v is None else float(v) for v in y]) for k, y in NULLS.items()], "id STRING, y ARRAY<DOUBLE>")
    got = df.select("id", *[f(F.col("y")).alias(n) for n, f in sparse_demand.METHODS.items()]).collect()
    for r in got:
        for name, value in by_hand_with_nulls(NULLS[r["id"]]).items():
            assert r[name] == (None if value is None else pytest.approx(value)), (r["id"], name)


def sparse_ship(spark):
    from test_operators import ship

    lumpy = [0, 0, 0, 9, 0, 0, 0, 0, 25, 0, 0, 1] * 5
    return ship(spark, {("L", "DOM"): lumpy, ("L", "EXP"): lumpy[::-1], ("N", "DOM"): lumpy[:6] + [0] * 54})


def test_winners_work_out_each_score_once(spark):
    data = sparse_ship(spark)
    scores = forecasting.mm_evaluate(forecasting.mm_train(data), forecasting.SPARSE)
    winners = forecasting.sparse_winners(scores, demand.route_series(demand.classify(data, spec.SERIES), "C"))
    plan = winners._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 1  # a filter on the scores held them twice more, with all forecasts in them
    assert plan.count("ArrowEvalPython") == 1
    mean = {}
    for r in scores.collect():
        mean.setdefault(r["unique_id"], {}).setdefault(r["model"], []).append(r["metric_value"])
    want = {s: min((round(sum(v) / len(v), 9), m) for m, v in by.items()) for s, by in mean.items()}
    assert {r["unique_id"]: (r["avg_metric"], r["model"]) for r in winners.collect()} == {
        s: (pytest.approx(v), m) for s, (v, m) in want.items()}


def test_models_without_any_score_do_not_win(spark):
    rows = [("A", "tsb", 0, None), ("A", "adida", 0, 0.5), ("A", "adida", 1, None), ("B", "tsb", 0, None)]
    best = forecasting.best_models(spark.createDataFrame(rows, "unique_id STRING, model STRING, window_no INT, metric_value DOUBLE"))
    assert [(r["unique_id"], r["model"], r["avg_metric"]) for r in best.collect()] == [("A", "adida", 0.5)]


# a series is one row before anything travels, and its levels are worked out once

def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pack_puts_months_together_before_the_shuffle(spark):
    rows = [("a", 3, 1.0), ("b", 2, None), ("a", 1, 5.0), ("a", 2, 0.0), ("b", 2, 4.0), ("b", 1, 7.0), (None, 1, 2.0), ("a", 2, -1.0)]
    df = spark.createDataFrame([(k, f"2024-0{m}-28", v) for k, m, v in rows], "k STRING, d STRING, v DOUBLE").withColumn("d", F.last_day("d"))
    packed = forecasting.pack(df.repartition(5), "k", "d", "v")
    plan = packed._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("ObjectHashAggregate"), plan.rindex("ObjectHashAggregate")
    assert "Exchange" in plan[final:partial]
    assert packed.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = {r["k"]: (r["last_ym"].month, r["y"]) for r in packed.collect()}
    assert got == {"a": (3, [5.0, -1.0, 0.0, 1.0]), "b": (2, [7.0, None, 4.0]), None: (1, [2.0])}


def test_series_off_the_route_are_left_out_before_gaps_are_filled(spark):
    from demandloom.operators.densify import densify

    data = sparse_ship(spark).filter("qty > 0")
    routes = demand.route_series(demand.classify(data, spec.SERIES), "C").withColumn(
        "forecast_source", F.when(F.col("item_code") == "L", spec.SEPARATE_ROUTE).otherwise(spec.MAIN_ROUTE))
    ends = data.agg(F.min("ym").alias("first"), F.max("ym").alias("last"))
    dense = densify(data, spec.SERIES, "ym", "qty", ends.select("first").scalar(), ends.select("last").scalar())
    routed = forecasting.on_route(dense, routes, spec.SEPARATE_ROUTE)
    plan = optimized(routed)
    assert plan.rindex("Generate") < plan.index("Join LeftSemi")
    want = dense.filter("item_code = 'L'").collect()
    assert sorted(map(tuple, routed.collect())) == sorted(map(tuple, want)) and len(want) > 100


def test_levels_are_worked_out_once_for_all_methods(spark):
    train = forecasting.mm_train(sparse_ship(spark))
    for df in (forecasting.mm_evaluate(train, forecasting.SPARSE), forecasting.mm_score(train, forecasting.SPARSE)):
        plan = optimized(df)
        assert plan.count("ArrowEvalPython") == 1 and plan.index("inline(") < plan.index("ArrowEvalPython")


def test_sparse_forecasts_and_scores_by_hand(spark):
    train = forecasting.mm_train(sparse_ship(spark))
    series = {r["unique_id"]: r["y"] for r in forecasting.pack(train, "unique_id", "ds", "y").collect()}
    ahead = {}
    for r in forecasting.mm_score(train, forecasting.SPARSE).collect():
        ahead.setdefault((r["unique_id"], r["model"]), {})[r["target_ym"]] = (r["p50"], r["lower_bound"], r["upper_bound"])
    assert len(ahead) == 9
    for (name, model), months in ahead.items():
        assert list(months.values()) == [(pytest.approx(by_hand(series[name])[model]), None, None)] * 18
    scores = forecasting.mm_evaluate(train, forecasting.SPARSE).collect()
    assert len(scores) == 18
    for r in scores:
        y = series[r["unique_id"]]
        cut = len(y) - 24 + 6 * r["window_no"]
        level = by_hand(y[:cut])[r["model"]]
        errors = [0.0 if abs(a) + level == 0 else 2 * abs(a - level) / (abs(a) + level) for a in y[cut:cut + 18]]
        assert r["metric_value"] == pytest.approx(sum(errors) / 18)


def test_sparse_methods_beside_rules_and_fits(spark):
    train = forecasting.mm_train(sparse_ship(spark))
    both = forecasting.mm_score(train, ("tsb", "zero", "theta"))
    alone = [forecasting.mm_score(train, (m,)) for m in ("tsb", "zero", "theta")]
    assert sorted(map(tuple, both.collect()), key=str) == sorted((tuple(r) for df in alone for r in df.collect()), key=str)
    chosen = spark.createDataFrame([("L|DOM", "imapa", "x"), ("L|EXP", "mean_12", "x"), ("N|DOM", "theta", "x")], "unique_id STRING, model STRING, forecast_source STRING")
    routed = {(r["unique_id"], r["model"], r["target_ym"]): r["p50"] for r in forecasting.score_routed(train, chosen).collect()}
    plain = {tuple(r)[:3]: r["p50"] for r in forecasting.mm_score(train, ("imapa", "mean_12", "theta")).collect()}
    assert len(routed) == 54 and routed == {k: pytest.approx(v) for k, v in plain.items() if k in routed}
