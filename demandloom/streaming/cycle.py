"""The monthly update: ingest, rebuild, retrain, promote, score."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.calendar import latest, month_end
from demandloom.operators import forecasting
from demandloom.operators.accuracy import accuracy_all
from demandloom.operators.demand import classify, enough_history, route_series
from demandloom.operators.features import build_features, temporal_split, training_frame
from demandloom.operators.quality import RULES, quality_counts
from demandloom.plans import lifecycle
from demandloom.plans.gold import GOLD_TABLES, Gold, Silver, StoredGold
from demandloom.plans.registry import Registry
from demandloom.plans.silver import clean
from demandloom.session import checkpoint_root
from demandloom.sources.tables import TABLE_COMMENTS, append_table, existing, replace_partitions, replace_table
from demandloom.streaming.bronze import INGEST_DAY, ingest_all, set_table_property, table_property

# columns each stored relation is laid out by.
LAYOUT = {
    "silver_shipments": ("ym", "item_code"), "silver_inventory": ("ym", "item_code"),
    "silver_forecast_baseline": ("target_ym", "item_code"),
    "fct_shipments": ("ym", "item_code"), "fct_inventory": ("ym", "item_code"),
    "fct_forecast_baseline": ("target_ym", "item_code"), "fct_forecast_accuracy": ("target_ym", "item_code"),
}
# month column of the relations that grow month by month; each is partitioned by it
MONTH_OF = {
    "silver_shipments": "ym", "silver_inventory": "ym", "silver_forecast_baseline": "target_ym",
    "fct_shipments": "ym", "fct_inventory": "ym", "fct_forecast_baseline": "target_ym", "fct_forecast_accuracy": "target_ym",
}
REFRESHED = "refreshed.through"
FORECAST_TABLES = ("fct_forecast_baseline", "fct_forecast_model", "fct_forecast_ai")


@dataclass(frozen=True)
class Workspace:
    """Where a run reads and writes."""

    spark: SparkSession
    database: str
    landing: str
    root: str | None = None

    @property
    def folder(self) -> str:
        return self.root or checkpoint_root(self.spark)

    def registry(self) -> Registry:
        return Registry(self.spark, self.database, self.folder)

    def store(self, df: DataFrame, name: str, evolve: bool = False) -> None:
        comment = next((text for table, text in TABLE_COMMENTS.items() if name == table or name.endswith(f"_{table}")), None)
        replace_table(df, f"{self.database}.{name}", comment, LAYOUT.get(name, ()), evolve, MONTH_OF.get(name))

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")


def refresh(ws: Workspace) -> StoredGold:
    """New files into bronze, then silver and gold rebuilt in full from the stored layer before."""
    ingest(ws)
    return rebuild(ws)


def ingest(ws: Workspace) -> None:
    ws.spark.sql(f"CREATE DATABASE IF NOT EXISTS {ws.database}")
    ingest_all(ws.spark, ws.landing, ws.database, f"{ws.folder}/progress")


def rebuild(ws: Workspace) -> StoredGold:
    """Silver from all of bronze, gold from all of silver."""
    for feed in spec.SOURCES:
        bronze = ws.table(f"bronze_{feed}")
        ws.store(clean(bronze, feed), f"silver_{feed}")
        _record_quality(ws, feed)
        _mark(ws, feed, bronze)
    gold = Gold(stored_silver(ws))
    for table in GOLD_TABLES:
        ws.store(getattr(gold, table), table)
    return StoredGold(ws.spark, ws.database)


def stored_silver(ws: Workspace) -> Silver:
    return Silver(**{feed: ws.table(f"silver_{feed}") for feed in spec.SOURCES})


def _record_quality(ws: Workspace, feed: str, scope: Column | None = None) -> None:
    """Add the rule counts of what was just rebuilt to `data_quality`; no row is dropped for them."""
    if feed in RULES:
        rows = ws.table(f"silver_{feed}")
        counts = quality_counts(rows if scope is None else rows.filter(scope), feed)
        append_table(counts.withColumn("checked_at", F.current_timestamp()), f"{ws.database}.data_quality")


def _mark(ws: Workspace, feed: str, arrived: DataFrame) -> None:
    """Remember on the silver table up to which ingest it has been rebuilt."""
    through = arrived.agg(F.unix_micros(F.max("_ingested_at"))).head()[0]
    before = table_property(ws.spark, f"{ws.database}.silver_{feed}", REFRESHED)
    if through is not None or before is None:  # a feed without any row yet counts as rebuilt, too
        set_table_property(ws.spark, f"{ws.database}.silver_{feed}", REFRESHED, str(through or 0))


def _arrived(ws: Workspace, feed: str) -> DataFrame | None:
    """Bronze rows ingested since silver was last rebuilt.

    The day filter prunes folders; it leaves a day of slack for runs in another time zone.
    """
    through = table_property(ws.spark, f"{ws.database}.silver_{feed}", REFRESHED)
    if through is None:
        return None
    since = F.timestamp_micros(F.lit(int(through)))
    return ws.table(f"bronze_{feed}").filter(
        (F.col(INGEST_DAY) >= F.date_sub(F.to_date(since), 1)) & (F.col("_ingested_at") > since))


def in_months(day: str, months: list) -> Column:
    """Any day of the given months (a missing month stands for rows without one)."""
    known = [m for m in months if m is not None]
    found = F.lit(False)
    if known:  # the range prunes files, the list is a look-up however long it is
        found = F.col(day).between(min(known).replace(day=1), max(known)) & month_end(day).isin(known)
    return found | F.col(day).isNull() if None in months else found


def repriced_months(shipments: DataFrame, old: DataFrame, new: DataFrame) -> list:
    """Months in which an item shipped whose price the new item master has otherwise than the old one."""
    was, now = (df.select("item_code", F.struct("unit_price").alias(name)) for df, name in ((old, "was"), (new, "now")))
    changed = was.join(now, "item_code", "full").filter(~F.col("was").eqNullSafe(F.col("now"))).select("item_code")
    return [r[0] for r in shipments.join(changed, "item_code", "left_semi").select("ym").distinct().collect()]


def refresh_months(ws: Workspace) -> StoredGold:
    """Like `refresh`, rebuilding only the months that new rows touch.

    A key holds its month, so a new row can change nothing outside that month; the touched
    months are rebuilt from all bronze rows of theirs and replace their folders. New item
    masters reach as far as what changed in them: items whose price is another one, new or gone
    count in the months in which they shipped. Only a first run, with nothing to build on,
    rebuilds in full. The item master is replaced after all that depends on it and marks
    advance last, so a run that broke off is simply repeated.
    """
    ingest(ws)
    arrived = {feed: _arrived(ws, feed) for feed in spec.SOURCES}
    stored = all(ws.spark.catalog.tableExists(f"{ws.database}.{t}") for t in GOLD_TABLES)
    if not stored or None in arrived.values():
        return rebuild(ws)

    touched = {}
    for feed, rows in arrived.items():
        month = MONTH_OF.get(f"silver_{feed}")
        if month:
            touched[feed] = [r[0] for r in rows.select(month_end(month)).distinct().collect()]

    def put(df: DataFrame, name: str) -> None:
        replace_partitions(df, f"{ws.database}.{name}", LAYOUT.get(name, ()))

    for feed, months in touched.items():
        month = MONTH_OF[f"silver_{feed}"]
        if months:
            put(clean(ws.table(f"bronze_{feed}").filter(in_months(month, months)), feed), f"silver_{feed}")
            _record_quality(ws, feed, in_months(month, months))
    for feed in ("channels", "lead_time"):
        if arrived[feed].head() is not None:
            ws.store(clean(ws.table(f"bronze_{feed}"), feed), f"silver_{feed}")

    silver = stored_silver(ws)
    ship, plan = touched["shipments"], touched["forecast_baseline"]
    new_items = arrived["items"].head() is not None
    if new_items:
        silver = replace(silver, items=clean(ws.table("bronze_items"), "items"))
        ship = list(dict.fromkeys([*ship, *repriced_months(silver.shipments, ws.table("silver_items"), silver.items)]))
    scoped = Gold(replace(
        silver,
        shipments=silver.shipments.filter(in_months("ym", ship)),
        inventory=silver.inventory.filter(in_months("ym", touched["inventory"])),
        forecast_baseline=silver.forecast_baseline.filter(in_months("target_ym", plan))))
    either = list(dict.fromkeys([*touched["shipments"], *plan]))
    scored = Gold(replace(
        silver, shipments=silver.shipments.filter(in_months("ym", either)),
        forecast_baseline=silver.forecast_baseline.filter(in_months("target_ym", either))))
    for name, months, gold in (("fct_shipments", ship, scoped), ("fct_inventory", touched["inventory"], scoped),
                               ("fct_forecast_baseline", plan, scoped), ("fct_forecast_accuracy", either, scored)):
        if months:
            put(getattr(gold, name), name)
    full = Gold(silver)
    for name, feed in (("dim_item", "items"), ("dim_channel", "channels"), ("dim_lead_time", "lead_time")):
        if arrived[feed].head() is not None:
            ws.store(getattr(full, name), name)
    if new_items:
        ws.store(silver.items, "silver_items")
        _record_quality(ws, "items")
    for feed, rows in arrived.items():
        _mark(ws, feed, rows)
    return StoredGold(ws.spark, ws.database)


def feature_frame(ship: DataFrame) -> DataFrame:
    return training_frame(build_features(ship.select(*spec.SHIPMENT_KEY, "qty")))


def _split(ws: Workspace, gold: StoredGold, built_ago: int) -> DataFrame:
    """Split feature frame, stored once so that trees and comparisons do not rebuild it."""
    frame = temporal_split(feature_frame(gold.fct_shipments), gold.fct_shipments, built_ago=built_ago)
    ws.store(frame, "feature_frame")
    return ws.spark.table(f"{ws.database}.feature_frame")


def _newest(frame: DataFrame, split: str) -> Column:
    return frame.filter(F.col("split") == split).agg(F.max("ym")).head()[0]


def _figures(row: dict) -> dict[str, str]:
    """Tag values of the metrics that are defined; a score over nothing or over an error of 0 is not."""
    return {k: f"{row[k]:.4f}" for k in ("mae", "mase", "baseline_mae") if row[k] is not None}


def initial_train(ws: Workspace, gold: StoredGold, grid=spec.TRIAL_GRID) -> int:
    """Train the grid as of half a year ago, register the best run as champion."""
    registry = ws.registry()
    frame = _split(ws, gold, spec.BUILT_MONTHS_AGO)
    models, trials = lifecycle.train_trials(frame, grid, f"{ws.folder}/training")
    through, available = _newest(frame, "train"), _newest(frame, "valid")
    rows = sorted((r.asDict() for r in trials.collect()), key=lambda r: (r["mae"] is None, r["mae"] or 0.0, r["name"]))
    runs = {r["name"]: registry.log_run(r["name"], r, r, through, available) for r in rows}
    best = rows[0]
    version = registry.register(models[best["name"]], runs[best["name"]])
    registry.set_alias("champion", version)
    registry.tag(version, {**_figures(best),
                           "trained_through": through, "data_available_through": available})
    return version


def retrain(ws: Workspace, gold: StoredGold) -> dict:
    """Challenger on the newest data with the champion's settings; promoted only if it wins."""
    registry = ws.registry()
    champion = registry.resolve("champion")
    if champion is None:
        raise LookupError("no champion is registered: run initial_train first")
    params = registry.params_of(champion)
    frame = _split(ws, gold, 0)
    model = lifecycle.train(frame.filter(F.col("split") == "train"), params, f"{ws.folder}/training")
    valid = frame.filter(F.col("split") == "valid")
    both = {"champion": registry.load(champion), "challenger": model}
    scores = lifecycle.compare(lifecycle.predictions(valid, both), both)
    by_name = {r["name"]: r.asDict() for r in scores.collect()}
    through = _newest(frame, "train")
    run = registry.log_run("retrain", params, by_name["challenger"], through, _newest(frame, "valid"))
    challenger = registry.register(model, run)
    registry.set_alias("challenger", challenger)
    registry.tag(challenger, {**_figures(by_name["challenger"]),
                              "trained_through": through})
    promoted = lifecycle.decide(ws.spark.createDataFrame(list(by_name.values()), scores.schema)).head()["promote"]
    if promoted:
        registry.set_alias("champion", challenger)
    return {"champion": champion, "challenger": challenger, "promoted": promoted, "scores": by_name}


def score(ws: Workspace, gold: StoredGold, run_date: str) -> None:
    """Champion's forecasts, then the accuracy of every forecast relation that exists."""
    registry = ws.registry()
    champion = registry.resolve("champion")
    if champion is None:
        raise LookupError("no champion is registered: run initial_train first")
    through = registry.run_of(champion)["trained_through"]
    forecast = lifecycle.batch_score(feature_frame(gold.fct_shipments), registry.load(champion), champion,
                                     run_date, str(through))
    ws.store(forecast, "fct_forecast_model", evolve=True)
    sources = existing(ws.spark, [f"{ws.database}.{t}" for t in FORECAST_TABLES])
    ws.store(accuracy_all([ws.spark.table(t) for t in sources], gold.fct_shipments), "fct_forecast_accuracy_all")


def grouped_forecasts(ws: Workspace, gold: StoredGold) -> None:
    """One forecast of all series past the data, then the hidden last year appended to the same table.

    Series that the history gate refuses have no rows; `demand.history_gate` lists them.
    """
    ship, last = enough_history(gold.fct_shipments), latest(gold.fct_shipments)
    ws.store(forecasting.grouped_forecast(ship, last_month=last), "fct_forecast_ai", evolve=True)
    append_table(forecasting.backtest_holdout(ship, last_month=last), f"{ws.database}.fct_forecast_ai")


def many_models(ws: Workspace, gold: StoredGold, use_case: str = "scm", models=tuple(forecasting.MODELS),
                policy: str = "B") -> None:
    """Backtest every model on every series with enough history, keep the best per series, route the hard ones, and score.

    Under policy C the hard ones are left to `sparse_models`.

    Each step is stored and the next reads it back, so that no fit runs twice and a lost
    executor costs a stage, not the run.
    """
    def stored(df: DataFrame, name: str) -> DataFrame:
        ws.store(df, f"{use_case}_{name}", evolve=True)
        return ws.spark.table(f"{ws.database}.{use_case}_{name}")

    ship, last = enough_history(gold.fct_shipments), latest(gold.fct_shipments)
    routes = stored(route_series(classify(ship, spec.SERIES, last), policy), "routes")
    if policy == "C":
        sparse_models(ws, ship, routes)
        ship, routes = (forecasting.on_route(df, routes, spec.MAIN_ROUTE) for df in (ship, routes))
    train = stored(forecasting.mm_train(ship), "train_data")
    evaluation = stored(forecasting.mm_evaluate(train, models), "evaluation_output")
    stored(forecasting.mm_score(train, models), "scoring_output")
    best = forecasting.best_models(evaluation, ties="first")
    chosen = stored(forecasting.routed_models(best, routes), "best_models")
    stored(forecasting.evaluation_summary(chosen, gold.dim_item), "evaluation_summary")
    stored(forecasting.score_routed(train, chosen), "routed_forecasts")


def sparse_models(ws: Workspace, ship: DataFrame, routes: DataFrame, use_case: str = "sparse") -> None:
    """The run of the series on the separate route, with methods for few demands and tables of its own."""
    def stored(df: DataFrame, name: str) -> DataFrame:
        ws.store(df, f"{use_case}_{name}", evolve=True)
        return ws.spark.table(f"{ws.database}.{use_case}_{name}")

    train = stored(forecasting.mm_train(forecasting.on_route(ship, routes, spec.SEPARATE_ROUTE)), "train_data")
    evaluation = stored(forecasting.mm_evaluate(train, forecasting.SPARSE), "evaluation_output")
    chosen = stored(forecasting.sparse_winners(evaluation, routes), "best_models")
    stored(forecasting.score_routed(train, chosen), "forecasts")


def score_versions(ws: Workspace, gold: StoredGold) -> DataFrame:
    """Scores of every registered version on the newest windows: one row per version and window.

    Only versions that have no score for the window yet are loaded, each scored on the stored
    rows by a plan of its own, and appended; a second run in the same month adds nothing.
    """
    registry, table = ws.registry(), f"{ws.database}.model_version_scores"
    through = latest(gold.fct_shipments)
    known = registry.table("model_versions").select("version")
    if existing(ws.spark, [table]):
        done = ws.spark.table(table).filter(F.col("window_ym") == through).select("version")
        known = known.join(done, "version", "left_anti")
    numbers = [r[0] for r in known.orderBy("version").collect()]
    if numbers:
        frame = temporal_split(feature_frame(gold.fct_shipments), gold.fct_shipments, built_ago=0)
        ws.store(frame.filter(F.col("split") == "valid"), "version_window", evolve=True)
    for n in numbers:
        scores = lifecycle.stack_versions(ws.table("version_window"), {n: registry.load(n)})
        append_table(scores.select(through.alias("window_ym"), "*", F.current_timestamp().alias("scored_at")), table)
    return ws.spark.table(table).filter(F.col("window_ym") == through)


def compare_all_versions(ws: Workspace, gold: StoredGold) -> DataFrame:
    """Every registered version with its scores on the newest windows, stored as a table."""
    scores = score_versions(ws, gold).drop("window_ym", "scored_at")
    known = ws.registry().versions().select("version", "alias", "trained_through")
    ws.store(known.join(scores, "version"), "model_version_comparison", evolve=True)
    return ws.spark.table(f"{ws.database}.model_version_comparison")


def monthly_cycle(ws: Workspace, run_date: str) -> dict:
    """Everything a new month triggers. Needs a champion from an earlier `initial_train`."""
    gold = refresh_months(ws)
    outcome = retrain(ws, gold)
    score(ws, gold, run_date)
    return outcome
