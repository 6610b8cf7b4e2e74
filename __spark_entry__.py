
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import demand_oracle
from demandloom import spec
from demandloom.functions import calendar, series
from demandloom.operators import accuracy, baseline, demand, dedup, features, forecasting, inventory, quality
from demandloom.plans import accuracy_reports, lifecycle, metrics, reports
from demandloom.plans.gold import Gold
from demandloom.plans.silver import clean
from demandloom.session import ship_code
from demandloom.sources import landing, tables
from demandloom.sources.star_schema import StarSchema, bronze_copy

try:  # the training-data queries, where their subpackage is there
    import corpus_pipeline
    from demandloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "demandloom.llm"):
        raise
    llm_queries = None

ship_code()

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
# Smaller ensembles than the default grid, so that the check finishes in minutes.
GRID = (
    {"name": "shallow", "max_depth": 3, "learning_rate": 0.10, "max_iter": 10},
    {"name": "standard", "max_depth": 5, "learning_rate": 0.10, "max_iter": 10},
)
PICK = ("Brand#1_ECONOMY", "DOM")
MESSY = {"商品コード": ("item_code", "text"), "年月": ("ym", "month"), "数量": ("qty", "number")}


def steady(df: DataFrame) -> DataFrame:
    """Fractions rounded, so that the order in which a sum was taken does not show."""
    return df.select(*[
        F.round(f"`{f.name}`", DIGITS).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


class Context:
    """Relations a query may ask for, over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.silver = StarSchema(spark, folder)
        self.gold = Gold(self.silver)

    @property
    def ship(self) -> DataFrame:
        return self.silver.shipments

    @property
    def parts(self) -> StarSchema:
        return StarSchema(self.spark, self.folder, grain="part")

    @property
    def rivals(self) -> list[DataFrame]:
        return [self.silver.forecast_baseline, *(baseline.rolling_rule(self.ship, r) for r in ("mean_12", "last_value"))]

    @property
    def scored(self) -> DataFrame:
        return accuracy.accuracy_all(self.rivals, self.ship)

    @property
    def features(self) -> DataFrame:
        return features.build_features(self.ship, self.origin)

    @property
    def origin(self):
        return F.year(self.silver.first_month)

    @property
    def last(self):
        return self.silver.last_month

    @property
    def span(self):
        return self.silver.first_month, self.silver.last_month

    @property
    def training(self) -> DataFrame:
        return features.training_frame(self.features)

    def split(self, built_ago: int) -> DataFrame:
        return features.temporal_split(self.training, self.silver.months, built_ago=built_ago)

    @property
    def train(self) -> DataFrame:
        return forecasting.mm_train(self.ship)

    @property
    def by_series(self) -> DataFrame:
        return demand.classify(self.ship, spec.SERIES, self.last)

    @property
    def part_routes(self) -> DataFrame:
        return demand.route_series(demand.classify(self.parts.sparse_shipments, spec.SERIES, self.last), "C")

    @property
    def sparse_train(self) -> DataFrame:
        return forecasting.mm_train(forecasting.on_route(self.parts.shipments, self.part_routes, spec.SEPARATE_ROUTE))

    @property
    def sparse_scores(self) -> DataFrame:
        return forecasting.mm_evaluate(self.sparse_train, forecasting.SPARSE)

    def rules_evaluated(self) -> DataFrame:
        return forecasting.mm_evaluate(self.train, forecasting.RULES)

    @property
    def best(self) -> DataFrame:
        return forecasting.best_models(self.rules_evaluated())

    def bronze(self, feed: str) -> DataFrame:
        """The feed as received twice, the older copy with one value and the day of month off."""
        if feed == "shipments":
            return self.silver.bronze_shipments
        change = {
            "items": {"unit_price": F.col("unit_price") + 1, "launch_ym": F.trunc("launch_ym", "month")},
            "channels": {"channel_name": F.upper("channel_name")},
            "inventory": {"closing_qty": F.col("closing_qty") + 1, "ym": F.trunc("ym", "month")},
            "lead_time": {"standard_lead_time_days": F.col("standard_lead_time_days") + 1},
            "forecast_baseline": {"p50": F.col("p50") + 1, "target_ym": F.trunc("target_ym", "month")},
        }[feed]
        return bronze_copy(getattr(self.silver, feed), change)

    @property
    def messy(self) -> DataFrame:
        """Shipments as a user might type them: text months, grouped digits, some bad, some twice."""
        rows = self.silver.sparse_shipments.select(
            F.col("item_code").alias("商品コード"),
            F.when((F.month("ym") == 2) & (F.col("channel") == "DOM"), F.lit("未定"))
            .otherwise(F.concat(F.year("ym"), F.lit("年"), F.month("ym"), F.lit("月"))).alias("年月"),
            F.format_number(F.col("qty") * 100, 0).alias("数量"),
        )
        return rows


def _dq(c: Context) -> DataFrame:
    counted = {"shipments": c.silver.bronze_shipments, "items": c.silver.items, "inventory": c.silver.inventory}
    first, *rest = [quality.quality_counts(df, name) for name, df in counted.items()]
    for other in rest:
        first = first.unionAll(other)
    return first


def _tolerance(c: Context) -> DataFrame:
    """Statistics of all months against those known a year earlier."""
    cutoff = calendar.shift_month_end(c.silver.last_month, -12)
    before = demand.demand_stats(c.ship.filter(F.col("ym") <= cutoff), ["item_code"], cutoff)
    return quality.tolerance_check(demand.demand_stats(c.ship, ["item_code"], c.last), before)


def _reconcile(c: Context) -> DataFrame:
    mine = {"fct_shipments": c.ship, "dim_item": c.silver.items, "dim_lead_time": c.silver.lead_time,
            "fct_forecast_baseline": c.silver.forecast_baseline}
    reference = {"fct_shipments": landing.split_load_set(c.ship, c.last, "A"), "dim_item": c.silver.items,
                 "dim_lead_time": c.silver.lead_time}
    return tables.reconcile_counts(mine, reference)


def _rules_compared(c: Context, by: tuple[str, ...] = ()) -> DataFrame:
    """Two rules as if they were champion and challenger, on the newest twelve and three months."""
    valid = c.split(0).filter(F.col("split") == "valid")
    named = valid.withColumns({"champion": F.col("lag_1"), "challenger": F.col("roll_mean_12")})
    return lifecycle.compare(named, ["champion", "challenger"], by=by)


def _safety(c: Context) -> DataFrame:
    return inventory.planned_safety_stock(c.ship, c.silver.items)


def _trials(c: Context) -> DataFrame:
    return lifecycle.train_trials(c.split(spec.BUILT_MONTHS_AGO), GRID)[1]


def _model_forecasts(c: Context) -> DataFrame:
    frame = c.split(spec.BUILT_MONTHS_AGO)
    train = frame.filter(F.col("split") == "train")
    model = lifecycle.train(train, GRID[0])
    through = train.select(F.max("ym")).scalar()
    return lifecycle.batch_score(c.training, model, 1, str(c.silver.before), through)


def _challenger(c: Context) -> DataFrame:
    old = lifecycle.train(c.split(spec.BUILT_MONTHS_AGO).filter(F.col("split") == "train"), GRID[0])
    frame = c.split(0)
    new = lifecycle.train(frame.filter(F.col("split") == "train"), GRID[0])
    both = {"champion": old, "challenger": new}
    valid = frame.filter(F.col("split") == "valid")
    return lifecycle.compare(lifecycle.predictions(valid, both), both)


def _versions(c: Context) -> DataFrame:
    frame = c.split(0)
    models = lifecycle.fit_trials(frame.filter(F.col("split") == "train"), GRID)
    numbered = dict(enumerate(models.values(), start=1))
    return lifecycle.stack_versions(frame.filter(F.col("split") == "valid"), numbered)


def _routed(c: Context) -> DataFrame:
    first = forecasting.best_models(c.rules_evaluated(), ties="first")
    return forecasting.routed_models(first, demand.route_series(c.by_series))


def _nth_months(c: Context) -> DataFrame:
    newest = calendar.newest_months(c.silver.months, 12)
    return c.spark.range(1).select(*[F.get(newest, n - 1).alias(f"latest_{n}") for n in (1, 3, 12)])


def _part_accuracy(c: Context) -> DataFrame:
    ship = c.parts.shipments
    scored = accuracy.score(baseline.baseline_history(ship, c.span), ship)
    return scored.groupBy("item_code").agg(*accuracy_reports.error_measures())


QUERIES: dict[str, Callable[[Context], DataFrame]] = {
    # sources, load sets, ingest reports
    "load_set_a": lambda c: landing.split_load_set(c.ship, c.last, "A"),
    "load_set_b": lambda c: landing.split_load_set(c.ship, c.last, "B"),
    "scan_shipments": lambda c: c.gold.fct_shipments.select("item_code", "channel", "ym", "qty"),
    "messy_ingest": lambda c: landing.tidy(c.messy, MESSY),
    "ingest_report": lambda c: landing.ingest_report(landing.tidy(c.messy, MESSY), ["item_code", "ym"]),
    "reconcile_counts": _reconcile,
    # silver
    **{f"silver_{feed if feed != 'forecast_baseline' else 'baseline'}":
       (lambda c, feed=feed: clean(c.bronze(feed), feed)) for feed in spec.SOURCES},
    "dedup_lineitem": lambda c: dedup.latest_by(c.silver.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]),
    "month_end": lambda c: c.silver.bronze_shipments.select(
        "item_code", "channel", F.col("ym").alias("received"), calendar.month_end("ym").alias("ym"), "qty"),
    "dq_counts": _dq,
    "tolerance_check": _tolerance,
    # gold
    "fct_shipments": lambda c: c.gold.fct_shipments,
    "dim_item": lambda c: c.gold.dim_item,
    "dim_channel": lambda c: c.gold.dim_channel,
    "dim_lead_time": lambda c: c.gold.dim_lead_time,
    "fct_inventory": lambda c: c.gold.fct_inventory,
    "fct_forecast_baseline": lambda c: c.gold.fct_forecast_baseline,
    "fct_accuracy": lambda c: c.gold.fct_forecast_accuracy,
    # calendar, series, demand
    "densify": lambda c: c.ship,
    "horizon": lambda c: reports.horizon(c.gold),
    "nth_month": _nth_months,
    "as_of": lambda c: c.ship.filter(F.col("ym") <= calendar.shift_month_end(c.silver.last_month, -12)),
    "series_id": lambda c: c.ship.select(series.series_id(*spec.SERIES).alias("unique_id")).distinct().select(
        "unique_id", series.split_series_id("unique_id", 0).alias("item_code"),
        series.split_series_id("unique_id", 1).alias("channel")),
    "series_list": lambda c: reports.series_list(c.gold),
    "series_slice": lambda c: reports.series_slice(c.gold, *PICK),
    "demand_stats": lambda c: demand.demand_stats(c.ship, ["item_code"], c.last),
    "demand_class": lambda c: c.by_series,
    "route_series": lambda c: demand.route_series(c.by_series),
    "route_series_a": lambda c: demand.route_series(c.by_series, "A"),
    "route_series_c": lambda c: demand.route_series(c.by_series, "C"),
    "history_gate": lambda c: demand.history_gate(c.silver.sparse_shipments),
    "enough_history": lambda c: demand.enough_history(c.silver.sparse_shipments),
    "safety_stock": _safety,
    # baseline and scoring
    "baseline_naive": lambda c: baseline.baseline_history(c.ship, c.span),
    "baseline_future": lambda c: baseline.baseline_future(c.ship, span=c.span),
    "all_forecasts": lambda c: accuracy.all_forecasts(c.rivals),
    "accuracy_all": lambda c: c.scored,
    "unscorable_forecasts": lambda c: accuracy.unscorable(c.silver.forecast_baseline, c.ship),
    "forecast_coverage": lambda c: accuracy_reports.forecast_coverage(c.silver.forecast_baseline, c.silver.last_month),
    "source_spans": lambda c: accuracy_reports.source_spans(
        dict(zip(("baseline", "mean_12", "last_value"), c.rivals))),
    "accuracy_by_class": lambda c: accuracy_reports.accuracy_by_class(c.gold),
    "accuracy_by_model": lambda c: accuracy_reports.accuracy_by_model(c.scored),
    "accuracy_by_model_common": lambda c: accuracy_reports.accuracy_by_model(accuracy.common_support(c.scored)),
    "accuracy_by_series": lambda c: accuracy_reports.accuracy_by_series(c.gold),
    "distinct_counts": lambda c: accuracy_reports.distinct_counts(c.scored),
    "vs_baseline": lambda c: accuracy_reports.vs_baseline(c.scored),
    "smape": lambda c: accuracy_reports.smape_by_model(c.scored),
    "class_judge": lambda c: accuracy_reports.class_judge(c.rivals[1], c.rivals[0], c.ship, c.silver.items),
    "error_by_month": lambda c: accuracy_reports.error_by_month(c.rivals[1], c.rivals[0], c.ship),
    "pred_vs_actual": lambda c: accuracy_reports.pred_vs_actual(c.rivals[1], c.ship),
    "forecast_summary": lambda c: accuracy_reports.forecast_summary(c.silver.forecast_baseline),
    "interval_width": lambda c: accuracy_reports.interval_width(c.silver.forecast_baseline, c.silver.items),
    "freshness": lambda c: accuracy_reports.freshness(c.ship, c.scored),
    "ape_by_month": lambda c: accuracy_reports.ape_by_month(c.gold),
    "top_error_items": lambda c: accuracy_reports.top_error_items(c.gold),
    "ds_accuracy": lambda c: accuracy_reports.ds_accuracy(c.gold),
    "w_err_by_class": lambda c: accuracy_reports.w_err_by_class(c.gold),
    "next_month_top": lambda c: accuracy_reports.next_month_top(c.silver.forecast_baseline, c.last),
    # demand and inventory reports
    "ds_demand": lambda c: reports.ds_demand(c.gold),
    "monthly_totals": lambda c: reports.monthly_totals(c.gold),
    "last12_trend": lambda c: reports.last12_trend(c.gold),
    "class_profile": lambda c: reports.class_profile(c.gold),
    "channel_share": lambda c: reports.channel_share(c.gold),
    "domestic_items": lambda c: reports.domestic_items(c.gold),
    "top_items": lambda c: reports.top_items(c.gold),
    "most_intermittent": lambda c: reports.most_intermittent(c.gold),
    "w_kpi_qty": lambda c: reports.w_kpi_qty(c.gold),
    "w_kpi_amount": lambda c: reports.w_kpi_amount(c.gold),
    "w_kpi_error": lambda c: reports.w_kpi_error(c.gold),
    "w_trend_by_channel": lambda c: reports.w_trend_by_channel(c.gold),
    "w_qty_by_category": lambda c: reports.w_qty_by_category(c.gold),
    "ds_inventory": lambda c: reports.ds_inventory(c.gold),
    "w_stock_by_site": lambda c: reports.w_stock_by_site(c.gold),
    "w_stockouts": lambda c: reports.w_stockouts(c.gold),
    "inventory_health": lambda c: reports.inventory_health(c.gold),
    "latest_stockouts": lambda c: reports.latest_stockouts(c.gold),
    "surplus_sites": lambda c: reports.surplus_sites(c.gold),
    "top_lead_times": lambda c: reports.top_lead_times(c.gold),
    # metric views
    "mv_demand_by_category": lambda c: metrics.mv_demand(c.gold).query(
        ["category"], ["qty", "amount", "months", "avg_monthly_qty"]),
    "mv_demand_by_channel": lambda c: metrics.mv_demand(c.gold).query(["channel"], ["qty", "amount"]),
    "mv_demand_by_month": lambda c: metrics.mv_demand(c.gold).query(["month"], ["qty", "amount"]),
    "mv_demand_domestic": lambda c: metrics.mv_demand(c.gold).query(
        ["category"], ["qty", "avg_monthly_qty"], where=lambda d: ~d("domestic_only")),
    "mv_accuracy_by_class": lambda c: metrics.mv_forecast_accuracy(c.gold).query(
        ["demand_class"], ["avg_ape", "avg_abs_error", "hit_rate", "n"]),
    "mv_accuracy_by_category": lambda c: metrics.mv_forecast_accuracy(c.gold).query(
        ["category", "method"], ["avg_ape", "avg_abs_error", "hit_rate", "n"]),
    # features and splits
    "features_lag": lambda c: c.features.select(*spec.SHIPMENT_KEY, "lag_1", "lag_2", "lag_3", "lag_12"),
    "features_roll": lambda c: c.features.select(
        *spec.SHIPMENT_KEY, "roll_mean_3", "roll_mean_6", "roll_mean_12", "roll_std_6", "nonzero_ratio_12"),
    "features_cal": lambda c: c.features.select(*spec.SHIPMENT_KEY, "month", "month_index"),
    "training_frame": lambda c: c.training,
    "split_counts": lambda c: features.split_counts(c.split(spec.BUILT_MONTHS_AGO)),
    "baseline_mae": lambda c: c.split(spec.BUILT_MONTHS_AGO).filter(F.col("split") == "valid").agg(
        F.avg(series.abs_error(F.col("qty"), F.col("lag_12"))).alias("baseline_mae")),
    "mase": _rules_compared,
    "promotion_rule": lambda c: lifecycle.decide(_rules_compared(c, ("item_code",)), by=["item_code"]),
    # many models and grouped forecasts
    "mm_train": lambda c: c.train,
    "mm_evaluate_rules": lambda c: c.rules_evaluated(),
    "best_models": lambda c: c.best,
    "best_model_counts": lambda c: forecasting.summarise_best(c.best),
    "evaluation_summary": lambda c: forecasting.evaluation_summary(c.best, c.silver.items),
    "routed_models": _routed,
    "routed_forecasts": lambda c: forecasting.score_routed(c.train, _routed(c)),
    "group_forecast_rule": lambda c: forecasting.grouped_forecast(c.ship, model="naive_12", last_month=c.last),
    "group_forecast_seasonal": lambda c: forecasting.grouped_forecast(c.ship, model="seasonal_naive", last_month=c.last),
    "group_forecast_croston": lambda c: forecasting.grouped_forecast(
        c.ship, model="croston_sba", last_month=c.last).select(*spec.FORECAST_KEY, "p50"),
    "group_backtest_rule": lambda c: forecasting.backtest_holdout(c.ship, model="mean_12", last_month=c.last),
    "group_forecast": lambda c: forecasting.grouped_forecast(c.ship, last_month=c.last),
    "group_backtest": lambda c: forecasting.backtest_holdout(c.ship, last_month=c.last),
    "mm_evaluate": lambda c: forecasting.mm_evaluate(c.train),
    "mm_evaluate_arima": lambda c: forecasting.mm_evaluate(c.train, ["arima"]),
    "conformal_rule": lambda c: forecasting.conformal_forecast(c.train, "mean_12"),
    "mm_airline": lambda c: forecasting.mm_score(c.train, ["airline"]).select("unique_id", "model", "target_ym", "p50"),
    "mm_score": lambda c: forecasting.mm_score(c.train),
    # the separate run of series with few demands, at the finest grain
    "sparse_forecasts": lambda c: forecasting.mm_score(c.sparse_train, forecasting.SPARSE),
    "sparse_evaluate": lambda c: c.sparse_scores,
    "sparse_winners": lambda c: forecasting.sparse_winners(c.sparse_scores, c.part_routes),
    # one global model
    "train_trials": _trials,
    "best_trial": lambda c: lifecycle.best_trial(_trials(c)),
    "model_forecasts": _model_forecasts,
    "challenger_compare": _challenger,
    "retrain": lambda c: lifecycle.decide(_challenger(c)),
    "compare_versions": _versions,
    # the finest grain, where series outnumber everything else
    "part_demand_class": lambda c: demand.classify(c.parts.sparse_shipments, ["item_code"], c.last),
    "part_accuracy": _part_accuracy,
    "part_features": lambda c: features.build_features(c.parts.shipments, F.year(c.silver.first_month)).select(
        *spec.SHIPMENT_KEY, "lag_12", "roll_mean_12", "roll_std_6", "nonzero_ratio_12"),
}


def entry(spark: SparkSession) -> DataFrame:
    """How good is "same month last year", by demand class?"""
    return queries()["accuracy_by_class"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query as a callable of session and table folder."""
    def bind(build: Callable[[Context], DataFrame]) -> Query:
        return lambda spark, sf_dir: steady(build(Context(spark, sf_dir)))

    out = {name: bind(build) for name, build in QUERIES.items()}
    if llm_queries:
        out |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return out


def oracle_sql() -> dict[str, str]:
    """The same results as SQL over the same tables."""
    out = demand_oracle.statements()
    if llm_queries:
        out |= llm_queries.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
