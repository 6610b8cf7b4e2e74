"""Training, registry, promotion and the monthly update."""

from __future__ import annotations

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from demandloom import spec
from demandloom.operators import features
from demandloom.operators.inventory import stockout_flag
from demandloom.plans import lifecycle
from demandloom.plans.registry import Registry
from demandloom.streaming import cycle
from test_operators import month_ends, ship

GRID = ({"name": "a", "max_depth": 2, "learning_rate": 0.2, "max_iter": 3},
        {"name": "b", "max_depth": 3, "learning_rate": 0.2, "max_iter": 5})


def seasonal(spark, months=48, items=6):
    rng = np.random.default_rng(3)
    wave = 50 + 20 * np.sin(2 * np.pi * np.arange(months) / 12)
    return ship(spark, {(f"I{i}", "DOM"): [int(v) for v in rng.poisson(wave * (i + 1))] for i in range(items)})


@pytest.fixture(scope="module")
def frame(spark):
    base = seasonal(spark)
    return features.temporal_split(features.training_frame(features.build_features(base)), base).cache()


@pytest.mark.parametrize("old, new, mase, expected", [
    (10.0, 9.0, 0.9, True), (10.0, 9.0, 1.0, False), (10.0, 10.0, 0.5, False),
    (10.0, 11.0, 0.5, False), (10.0, 9.0, None, False)])
def test_promotion_truth_table(spark, old, new, mase, expected):
    scores = spark.createDataFrame([("champion", old, 0.8), ("challenger", new, mase)],
                                   "name STRING, mae_recent DOUBLE, mase_recent DOUBLE")
    assert lifecycle.decide(scores).first()["promote"] is expected
    if mase is not None:
        assert lifecycle.wins(old, new, mase) is expected


def test_trials_are_repeatable_and_ranked(frame):
    models, trials = lifecycle.train_trials(frame, GRID)
    _again, same = lifecycle.train_trials(frame, GRID)
    got = rows(trials)
    assert got == rows(same) and set(models) == {"a", "b"}
    assert trials.columns == ["name", "max_depth", "learning_rate", "max_iter", "mae", "mase", "baseline_mae"]
    best = lifecycle.best_trial(trials).first()
    assert best["mae"] == min(r[4] for r in got) and best["mase"] == pytest.approx(best["mae"] / best["baseline_mae"])


def test_comparison_matches_a_plain_average(frame):
    valid = frame.filter("split <> 'train'")
    pdf = valid.toPandas()
    got = lifecycle.compare(valid, ["lag_1"]).first()
    error, base = (pdf.qty - pdf.lag_1).abs(), (pdf.qty - pdf.lag_12).abs()
    assert got["mae"] == pytest.approx(error.mean()) and got["mase"] == pytest.approx(error.mean() / base.mean())
    assert got["mae_recent"] == pytest.approx(error[pdf.is_recent].mean())


def test_batch_scores_look_like_the_baseline(frame):
    train = frame.filter("split = 'train'")
    model = lifecycle.train(train, GRID[0])
    through = train.agg(F.max("ym")).first()[0]
    out = lifecycle.batch_score(frame, model, 7, "2024-02-10", str(through))
    assert out.columns[:8] == spec.SOURCES["forecast_baseline"].columns
    assert out.count() == frame.count()
    first = out.first()
    assert first["model_name"] == "demand_forecast_v7" and first["forecast_run_ym"] == dt.date(2024, 2, 29)
    assert first["lower_bound"] == pytest.approx(first["p50"] * 0.7) and out.filter("p50 < 0").count() == 0
    assert out.filter("is_out_of_sample").count() == frame.filter(F.col("ym") > through).count()


def test_registry(spark, database, folder, frame):
    registry = Registry(spark, database, folder)
    assert registry.resolve("champion") is None
    model = lifecycle.train(frame.filter("split = 'train'"), GRID[0])
    metrics = {"mae": 1.0, "mase": 0.5, "baseline_mae": 2.0}
    versions = [registry.register(model, registry.log_run(f"r{i}", GRID[i], metrics, dt.date(2023, 1, 31))) for i in (0, 1)]
    assert versions == [1, 2]
    registry.set_alias("champion", 1)
    registry.set_alias("challenger", 2)
    registry.set_alias("champion", 2)
    assert (registry.resolve("champion"), registry.resolve("challenger")) == (2, 2)
    registry.tag(1, {"mae": "1.0"})
    registry.tag(1, {"mae": "0.9"})
    assert rows(registry.tags()) == [(1, "mae", "0.9")]
    assert registry.params_of(2) == {"max_depth": 3, "learning_rate": 0.2, "max_iter": 5}
    assert rows(registry.versions().select("version", "alias"), "version") == [(1, "-"), (2, "challenger, champion")]
    loaded = registry.load(1)
    probe = frame.limit(50).cache()
    assert rows(lifecycle.predictions(probe, {"p": loaded}).select("p")) == rows(lifecycle.predictions(probe, {"p": model}).select("p"))
    with pytest.raises(LookupError):
        registry.load(9)


def write(landing: str, feed: str, name: str, lines: list[tuple]) -> None:
    os.makedirs(f"{landing}/{feed}", exist_ok=True)
    with open(f"{landing}/{feed}/{name}", "w", encoding="utf-8") as f:
        f.write(",".join(spec.SOURCES[feed].columns) + "\n")
        f.writelines(",".join(str(v) for v in line) + "\n" for line in lines)


def land(spark, landing: str, months: int):
    """Landing folder of a small business with everything up to the month before the last."""
    from demandloom.operators.baseline import seasonal_naive

    base = seasonal(spark, months)
    ends = month_ends(dt.date(2020, 1, 31), months)
    lines = rows(base)
    write(landing, "shipments", "history.csv", [r for r in lines if r[2] < ends[-1]])
    items = sorted({r[0] for r in lines})
    write(landing, "items", "items.csv", [
        (i, f"Name {i}", "cat", "main", 10, "smooth", 1.0, 0.1, "false", "2020-01-31") for i in items])
    write(landing, "channels", "channels.csv", [("DOM", "Domestic", "d"), ("EXP", "Export", "e")])
    write(landing, "lead_time", "lead_time.csv", [(i, "S1", 3) for i in items])
    write(landing, "inventory", "inventory.csv", [(i, "S1", ends[0], 0, 5, 1) for i in items])
    write(landing, "forecast_baseline", "baseline.csv", [
        tuple(r) for r in seasonal_naive(base).select(*spec.SOURCES["forecast_baseline"].columns).collect()])
    return [r for r in lines if r[2] == ends[-1]], ends


def test_monthly_cycle(spark, database, folder):
    landing = f"{folder}/landing"
    newest, ends = land(spark, landing, 44)
    ws = cycle.Workspace(spark, database, landing, f"{folder}/shared")
    gold = cycle.refresh(ws)
    assert gold.fct_shipments.agg(F.max("ym")).first()[0] == ends[-2]
    with pytest.raises(LookupError, match="champion"):
        cycle.retrain(ws, gold)
    with pytest.raises(LookupError, match="champion"):
        cycle.score(ws, gold, "2024-01-05")
    assert cycle.initial_train(ws, gold, GRID) == 1
    assert ws.registry().table("model_runs").count() == 2

    write(landing, "shipments", "newest.csv", newest)
    outcome = cycle.monthly_cycle(ws, "2024-01-05")
    gold = cycle.StoredGold(spark, database)
    assert gold.fct_shipments.agg(F.max("ym")).first()[0] == ends[-1]
    assert gold.fct_shipments.count() == 44 * 6
    assert outcome["challenger"] == 2 and outcome["champion"] == 1
    assert ws.registry().resolve("champion") == (2 if outcome["promoted"] else 1)

    accuracy = spark.table(f"{database}.fct_forecast_accuracy_all")
    assert accuracy.agg(F.max("target_ym")).first()[0] == ends[-1]
    assert accuracy.filter(f"model_name = '{spec.BASELINE_MODEL}'").count() == 32 * 6
    assert accuracy.filter("model_name LIKE 'demand_forecast_v%'").count() == 32 * 6
    versions = cycle.compare_all_versions(ws, gold)
    assert rows(versions.select("version")) == [(1,), (2,)]
    first, load = rows(versions), Registry.load
    loaded = []
    Registry.load = lambda self, n: loaded.append(n) or load(self, n)
    try:
        assert rows(cycle.compare_all_versions(ws, gold)) == first and not loaded, "what has a score is not scored again"
        Registry(spark, database, ws.folder).register(load(ws.registry(), 1), 1)
        assert [r[0] for r in rows(cycle.compare_all_versions(ws, gold).select("version"))] == [1, 2, 3] and loaded == [3]
    finally:
        Registry.load = load
    assert spark.table(f"{database}.model_version_scores").count() == 3
    assert spark.table(f"{database}.model_runs").filter("logged_by IS NULL").isEmpty()
    cycle.grouped_forecasts(ws, gold)
    cycle.score(ws, gold, "2024-01-05")
    methods = spark.table(f"{database}.fct_forecast_accuracy_all").groupBy("model_name").count()
    assert dict(rows(methods))[spec.GROUPED_MODEL] == 12 * 6
    assert spark.table(f"{database}.fct_forecast_ai").count() == (18 + 12) * 6

    cycle.many_models(ws, gold, models=("ets", "theta", "croston_sba"))
    table = {t: spark.table(f"{database}.scm_{t}") for t in
             ("train_data", "evaluation_output", "scoring_output", "best_models", "evaluation_summary", "routed_forecasts")}
    assert {n: t.count() for n, t in table.items() if n != "evaluation_summary"} == {
        "train_data": 44 * 6, "evaluation_output": 6 * 3 * 2, "scoring_output": 6 * 3 * 18,
        "best_models": 6, "routed_forecasts": 6 * 18}
    assert table["evaluation_summary"].agg(F.sum("series_count")).first()[0] == 6

    again = cycle.refresh(ws)
    assert again.fct_shipments.count() == 44 * 6, "nothing new, nothing changes"


def test_stockout_needs_something_to_stock(spark):
    df = spark.createDataFrame([(0, 5), (0, 0), (3, 5)], "c INT, s INT")
    assert [r[0] for r in df.select(stockout_flag(F.col("c"), F.col("s"))).collect()] == [1, 0, 0]


def listing(spark, table: str) -> dict[str, set]:
    """Files of a table by month folder."""
    out: dict[str, set] = {}
    for path in spark.table(table).select("_metadata.file_path").distinct().collect():
        folder, name = path[0].rsplit("/", 2)[1:]
        out.setdefault(folder, set()).add(name)
    return out


def test_month_scoped_refresh_equals_a_full_one(spark, database, folder):
    landing = f"{folder}/landing"
    newest, ends = land(spark, landing, 26)
    ws = cycle.Workspace(spark, database, landing, f"{folder}/shared")
    cycle.refresh_months(ws)
    before = listing(spark, f"{database}.fct_shipments")

    resent = [(i, c, ym.replace(day=1), q + 7) for i, c, ym, q in rows(seasonal(spark, 26)) if ym == ends[20]]
    write(landing, "shipments", "newest.csv", [*newest, *resent, ("I0", "EXP", "", 3)])
    write(landing, "inventory", "more.csv", [("I0", "S1", ends[3], 9, 5, 0)])
    write(landing, "forecast_baseline", "more.csv", [("I0", "DOM", ends[20], ends[19], "other", 5.0, 1.0, 9.0)])
    write(landing, "lead_time", "more.csv", [("I0", "S1", 4)])
    cycle.refresh_months(ws)

    checked = spark.table(f"{database}.data_quality").filter("rule = 'ym_not_null'").orderBy("checked_at").collect()
    assert [(r["passed"], r["failed"]) for r in checked] == [(25 * 6, 0), (2 * 6, 1)]
    after = listing(spark, f"{database}.fct_shipments")
    changed = {m for m in after if after[m] != before.get(m)}
    assert changed == {f"ym={ends[20]}", f"ym={ends[25]}", "ym=__HIVE_DEFAULT_PARTITION__"}
    scoped = {t: rows(spark.table(f"{database}.{t}").select(*sorted(spark.table(f"{database}.{t}").columns)))
              for t in cycle.GOLD_TABLES}
    cycle.rebuild(ws)
    for t in cycle.GOLD_TABLES:
        full = spark.table(f"{database}.{t}")
        assert rows(full.select(*sorted(full.columns))) == scoped[t], t
    assert spark.table(f"{database}.dim_lead_time").filter("item_code = 'I0'").first()["standard_lead_time_days"] == 4

    settled = listing(spark, f"{database}.fct_shipments")
    cycle.refresh_months(ws)
    assert listing(spark, f"{database}.fct_shipments") == settled, "nothing new, nothing rewritten"
    write(landing, "items", "more.csv", [("I0", "Name", "cat", "main", 99, "smooth", 1.0, 0.1, "false", "2020-01-31")])
    gold = cycle.refresh_months(ws)
    assert gold.fct_shipments.filter("item_code = 'I0' AND amount <> qty * 99").count() == 0


def test_a_price_change_rewrites_only_the_months_it_counts_in(spark, database, folder):
    landing = f"{folder}/landing"
    _newest, ends = land(spark, landing, 26)
    write(landing, "shipments", "rare.csv", [("I9", "DOM", ends[4], 5), ("I9", "EXP", ends[9], 6)])
    write(landing, "items", "nine.csv", [("I9", "Name", "cat", "main", 7, "lumpy", 9.0, 0.1, "false", "2020-05-31")])
    ws = cycle.Workspace(spark, database, landing, f"{folder}/shared")
    cycle.refresh_months(ws)

    def touched(work):
        before = listing(spark, f"{database}.fct_shipments")
        work()
        after = listing(spark, f"{database}.fct_shipments")
        return {m for m in after if after[m] != before.get(m)}

    def amounts():
        return rows(spark.table(f"{database}.fct_shipments").filter("item_code = 'I9'").select("qty", "amount"))

    write(landing, "items", "price.csv", [("I9", "Name", "cat", "main", 8, "lumpy", 9.0, 0.1, "false", "2020-05-31")])
    assert touched(lambda: cycle.refresh_months(ws)) == {f"ym={ends[4]}", f"ym={ends[9]}"}
    assert amounts() == [(5, 40), (6, 48)]
    write(landing, "items", "name.csv", [("I0", "Another", "cat", "main", 10, "smooth", 1.0, 0.1, "false", "2020-01-31")])
    assert touched(lambda: cycle.refresh_months(ws)) == set(), "a name is in no fact"
    assert spark.table(f"{database}.dim_item").filter("item_code = 'I0'").first()["item_name"] == "Another"

    # a run that breaks off before its end has the change before it again
    write(landing, "items", "again.csv", [("I9", "Name", "cat", "main", 9, "lumpy", 9.0, 0.1, "false", "2020-05-31")])
    store, real = [], cycle.Workspace.store

    def broken(self, df, name, evolve=False):
        store.append(name)
        if name == "silver_items":
            raise RuntimeError("lost")
        real(self, df, name, evolve)

    cycle.Workspace.store = broken
    try:
        with pytest.raises(RuntimeError, match="lost"):
            cycle.refresh_months(ws)
    finally:
        cycle.Workspace.store = real
    assert touched(lambda: cycle.refresh_months(ws)) == {f"ym={ends[4]}", f"ym={ends[9]}"}
    scoped = {t: rows(spark.table(f"{database}.{t}").select(*sorted(spark.table(f"{database}.{t}").columns))) for t in cycle.GOLD_TABLES}
    cycle.rebuild(ws)
    for t in cycle.GOLD_TABLES:
        full = spark.table(f"{database}.{t}")
        assert rows(full.select(*sorted(full.columns))) == scoped[t], t


def test_counts_follow_from_the_calendar(spark):
    """23 items, 7 of them domestic only, over 80 months: every derived count is fixed."""
    from demandloom.operators import accuracy, baseline

    series = [(f"K{i:02}", c) for i in range(23) for c in ("DOM", "EXP") if c == "DOM" or i >= 7]
    df = ship(spark, {s: [1] * 80 for s in series})
    months = df.select("ym").distinct().count()
    assert (len(series), df.count(), df.filter(F.col("ym") < df.agg(F.max("ym")).first()[0]).count()) == (39, 3_120, 3_081)
    history, future = baseline.baseline_history(df), baseline.baseline_future(df)
    assert (months, history.count(), future.count()) == (80, 68 * 39, 18 * 39)
    both = [baseline.seasonal_naive(df), baseline.rolling_rule(df, "mean_12")]
    assert accuracy.accuracy_all(both, df).count() == sum(accuracy.score(f, df).count() for f in both) == 2 * 2_652


def test_checkpoint_folder_comes_from_the_session(spark, scratch):
    from types import SimpleNamespace

    from demandloom.session import checkpoint_root

    assert checkpoint_root(spark) == f"{scratch}/shared"
    conf = SimpleNamespace(get=lambda key, default: default)
    far = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(far)


def test_staged_boosting_goes_on_where_it_broke_off(spark, folder, frame, monkeypatch):
    from pyspark.ml.regression import DecisionTreeRegressor

    from demandloom.plans import boosting

    train = frame.filter("split = 'train'")
    probe = frame.filter("split <> 'train'")
    params = {"name": "s", "max_depth": 3, "learning_rate": 0.2, "max_iter": 7}
    monkeypatch.setattr(boosting.boosted_grid, "__defaults__", (16, 3))
    grown, real = [], DecisionTreeRegressor.fit

    def counted(self, *args):
        grown.append(1)
        if counted.lost and len(grown) > counted.lost:
            raise RuntimeError("lost")
        return real(self, *args)

    monkeypatch.setattr(DecisionTreeRegressor, "fit", counted)

    def predicted(model):
        return rows(lifecycle.predictions(probe, {"p": model}).select(*spec.SHIPMENT_KEY, "p"))

    counted.lost = None
    whole = lifecycle.train(train, params, f"{folder}/whole")
    assert len(grown) == 7 and whole.stages[-1].getNumTrees == 7
    counted.lost = 7 + 5
    with pytest.raises(RuntimeError, match="lost"):
        lifecycle.train(train, params, f"{folder}/broken")
    counted.lost = None
    del grown[:]
    resumed = lifecycle.train(train.repartition(5), params, f"{folder}/broken")
    assert len(grown) == 4, "the first stage of three trees stood"
    assert predicted(resumed) == predicted(whole)
    del grown[:]
    lifecycle.train(train, params, f"{folder}/broken")
    assert not grown
    lifecycle.train(train.filter("item_code <> 'I0'"), params, f"{folder}/broken")
    assert len(grown) == 7, "other rows are another model"

    # the score is what the trees add up to, and more trees fit better
    features = lifecycle.assembler().transform(probe)
    parts = [t.transform(features).select(*spec.SHIPMENT_KEY, "prediction") for t in whole.stages[-1].trees]
    single = [{tuple(r)[:3]: r["prediction"] for r in p.collect()} for p in parts]
    for *key, p in predicted(whole)[:40]:
        total = single[0][tuple(key)] + 0.2 * sum(s[tuple(key)] for s in single[1:])
        assert p == pytest.approx(max(total, 0.0))
    stored = f"{folder}/saved"
    whole.write().overwrite().save(stored)
    from pyspark.ml import PipelineModel
    assert predicted(PipelineModel.load(stored)) == predicted(whole)


def test_settings_fitted_at_once_equal_those_alone(folder, frame):
    train = frame.filter("split = 'train'")
    both = lifecycle.fit_trials(train, GRID, f"{folder}/both")
    probe = frame.limit(60).cache()
    for g in GRID:
        alone = lifecycle.fit_trials(train, [g], f"{folder}/alone")[g["name"]]
        assert rows(lifecycle.predictions(probe, {"p": both[g["name"]]}).select("p")) == rows(lifecycle.predictions(probe, {"p": alone}).select("p"))
