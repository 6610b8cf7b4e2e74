"""Hand-made cases and properties of the relational operators."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import rows
from demandloom import spec
from demandloom.functions import calendar, series
from demandloom.operators import accuracy, baseline, demand, dedup, densify, inventory, metricview, quality
from demandloom.plans import accuracy_reports, gold

D = dt.date


def month_ends(first: D, n: int) -> list[D]:
    out = []
    for k in range(n):
        y, m = divmod(first.year * 12 + first.month - 1 + k + 1, 12)
        out.append(D(y, m + 1, 1) - dt.timedelta(days=1))
    return out


def ship(spark, values: dict[tuple[str, str], list[int]], first=D(2020, 1, 31)):
    data = [(i, c, ym, q) for (i, c), qs in values.items() for ym, q in zip(month_ends(first, len(qs)), qs)]
    return spark.createDataFrame(data, "item_code STRING, channel STRING, ym DATE, qty BIGINT")


def one(df):
    return df.collect()[0][0]


def test_month_arithmetic(spark):
    day = F.lit("2023-02-28").cast("date")
    df = spark.range(1)
    assert one(df.select(calendar.shift_month_end(day, 12))) == D(2024, 2, 29)
    assert one(df.select(calendar.month_end(F.lit("2024-02-03").cast("date")))) == D(2024, 2, 29)
    assert one(df.select(calendar.parse_year_month(F.lit("2024-02")))) == D(2024, 2, 29)
    assert one(df.select(calendar.parse_year_month(F.lit("soon")))) is None
    assert one(df.select(calendar.forecast_run_month("2024-04-02"))) == D(2024, 4, 30)
    assert one(df.select(calendar.month_number(F.lit(D(2000, 1, 31))) - calendar.month_number(F.lit(D(1999, 12, 31))))) == 1


def test_nth_latest(spark):
    df = ship(spark, {("A", "DOM"): [1, 2, 3], ("B", "DOM"): [1, 2, 3]})
    got = spark.range(1).select(*[calendar.nth_latest(df, n).alias(str(n)) for n in (1, 3, 4)]).first()
    assert tuple(got) == (D(2020, 3, 31), D(2020, 1, 31), None)


def test_series_id_round_trip(spark):
    df = spark.createDataFrame([("K210", "DOM")], "a STRING, b STRING").select(series.series_id("a", "b").alias("u"))
    assert tuple(df.select("u", series.split_series_id("u", 0), series.split_series_id("u", 1)).first()) == (
        "K210|DOM", "K210", "DOM")


def test_latest_by_is_stable_and_idempotent(spark):
    data = [("a", 1, "x", 5), ("a", 2, "x", 6), ("a", 2, "y", 4), ("b", 1, None, 7), (None, 1, "z", 1), (None, 2, "z", 0)]
    df = spark.createDataFrame(data, "k STRING, at INT, src STRING, v INT")
    once = dedup.latest_by(df, ["k"], ["at", "src"])
    assert set(rows(once)) == {("a", 2, "y", 4), ("b", 1, None, 7), (None, 2, "z", 0)}
    shuffled = dedup.latest_by(df.orderBy(F.rand(1)).repartition(3), ["k"], ["at", "src"])
    assert set(rows(shuffled)) == set(rows(dedup.latest_by(once, ["k"], ["at", "src"]))) == set(rows(once))


def test_latest_by_combines_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 4).select(F.lit("hot").alias("k"), "id")
    plan = dedup.latest_by(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_densify(spark):
    data = [("a", D(2020, 3, 31), 5), ("a", D(2020, 6, 30), 7), ("b", D(2020, 1, 31), 1)]
    df = spark.createDataFrame(data, "k STRING, ym DATE, qty INT")
    out = densify.densify(df, ["k"], "ym", "qty", F.lit(D(2020, 1, 31)), F.lit(D(2020, 7, 31)))
    assert rows(out.filter("k = 'a'"), "ym") == [
        ("a", m, q) for m, q in zip(month_ends(D(2020, 1, 31), 7), [0, 0, 5, 0, 0, 7, 0])]
    assert out.filter("k = 'b'").count() == 7 and out.agg(F.sum("qty")).first()[0] == 13
    again = densify.densify(out, ["k"], "ym", "qty", F.lit(D(2020, 1, 31)), F.lit(D(2020, 7, 31)))
    assert rows(again, "k", "ym") == rows(out, "k", "ym")


def test_baseline_prefers_last_year_and_falls_back(spark):
    df = ship(spark, {("A", "DOM"): list(range(30))})
    out = baseline.seasonal_naive(df, 18)
    got = {r["target_ym"]: r for r in out.collect()}
    ends = month_ends(D(2020, 1, 31), 48)
    assert len(got) == 18 + 18
    for i in range(12, 48):
        expected = float(i - 12 if i - 12 < 30 else i - 24)
        row = got[ends[i]]
        assert row["p50"] == expected
        assert row["lower_bound"] == int(expected * 0.6 + 0.5) and row["upper_bound"] == int(expected * 1.5 + 0.5)
        assert row["forecast_run_ym"] == (ends[i - 1] if i < 30 else ends[29])
    assert baseline.baseline_history(df).count() == baseline.baseline_future(df).count() == 18


def test_score_edges(spark):
    actual = ship(spark, {("A", "DOM"): [0, 10, 10, 10]})
    ends = month_ends(D(2020, 1, 31), 5)
    f = spark.createDataFrame(
        [("A", "DOM", ends[0], "m", 2.0, 0.0, 3.0), ("A", "DOM", ends[1], "m", 8.0, 10.0, 12.0),
         ("A", "DOM", ends[2], "m", 8.0, None, None), ("A", "DOM", ends[3], "m", 8.0, 7.0, 9.0),
         ("A", "DOM", ends[4], "m", 1.0, 0.0, 2.0)],
        "item_code STRING, channel STRING, target_ym DATE, model_name STRING, p50 DOUBLE, lower_bound DOUBLE, upper_bound DOUBLE")
    got = rows(accuracy.score(f, actual).select("abs_error", "ape", "within_interval", "target_ym"), "target_ym")
    assert [g[:3] for g in got] == [(2.0, None, 1), (2.0, 0.2, 1), (2.0, 0.2, 0), (2.0, 0.2, 0)]
    assert rows(accuracy.unscorable(f, actual)) == [("m", ends[4], ends[4], 1)]
    assert accuracy_reports.freshness(actual, accuracy.score(f, actual)).count() == 2


def test_amount_is_wide_and_unknown_items_stay(spark):
    df = ship(spark, {("A", "DOM"): [2_000_000_000], ("Z", "DOM"): [1]})
    items = spark.createDataFrame([("A", 2_000)], "item_code STRING, unit_price INT")
    assert rows(gold.fct_shipments(df, items).select("item_code", "amount")) == [("A", 4_000_000_000_000), ("Z", None)]


def test_demand_statistics(spark):
    stats = demand.demand_stats(ship(spark, {
        ("A", "DOM"): [0, 0, 4, 0, 8, 0], ("B", "DOM"): [0, 0, 0, 0, 0, 3], ("C", "DOM"): [0] * 6}), ["item_code"])
    got = {r["item_code"]: r for r in stats.collect()}
    assert (got["A"]["months"], got["A"]["nonzero_months"], got["A"]["adi"]) == (4, 2, 2.0)
    assert got["A"]["cv2"] == pytest.approx((2 / 6) ** 2) and got["A"]["mean_qty"] == 3.0
    assert (got["B"]["adi"], got["B"]["cv2"], got["B"]["mean_qty"]) == (1.0, 0.0, 3.0)
    assert got["C"]["adi"] is None and got["C"]["cv2"] is None


@pytest.mark.parametrize("adi, cv2, expected", [
    (1.0, 0.1, "smooth"), (1.31, 0.49, "erratic"), (1.32, 0.48, "intermittent"), (1.32, 0.49, "lumpy"),
    (1.0, 1.1, "lumpy_severe"), (5.0, 2.0, "lumpy_severe"), (None, None, None)])
def test_demand_class(spark, adi, cv2, expected):
    df = spark.createDataFrame([(adi, cv2)], "adi DOUBLE, cv2 DOUBLE")
    assert one(df.select(demand.demand_class())) == expected


def test_routes(spark):
    df = spark.createDataFrame([(c,) for c in (*spec.DEMAND_CLASSES, None)], "demand_class STRING")
    for policy, hard in (("A", "main_pipeline"), ("B", "simple_rule"), ("C", "separate_pipeline")):
        got = dict(rows(demand.route_series(df, policy)))
        assert got.pop("smooth") == got.pop("erratic") == "main_pipeline"
        assert set(got.values()) == {hard}


def test_history_gate(spark):
    df = ship(spark, {("A", "DOM"): [1] * 24, ("B", "DOM"): [1] * 23})
    assert rows(demand.history_gate(df)) == [("A", "DOM", 24, True), ("B", "DOM", 23, False)]
    assert {r[0] for r in rows(demand.enough_history(df))} == {"A"}
    sparse = df.filter("item_code = 'A' AND month(ym) IN (1, 12)")
    length = sparse.agg((F.max(F.year("ym") * 12 + F.month("ym")) - F.min(F.year("ym") * 12 + F.month("ym")) + 1)).first()[0]
    assert rows(demand.history_gate(sparse)) == [("A", "DOM", length, length >= 24)]


def test_quality_counts_and_keeps(spark):
    data = [("a", "DOM", D(2020, 1, 31), 1), (None, "XXX", None, -1), ("b", None, D(2020, 1, 31), None)]
    df = spark.createDataFrame(data, "item_code STRING, channel STRING, ym DATE, qty INT")
    got = {r["rule"]: (r["passed"], r["failed"], r["unknown"]) for r in quality.quality_counts(df, "shipments").collect()}
    assert got == {"item_code_not_null": (2, 1, 0), "channel_is_known": (1, 1, 1),
                   "ym_not_null": (2, 1, 0), "qty_not_negative": (1, 1, 1)}
    seen = Observation("dq")
    assert quality.observe_quality(df, "shipments", seen).count() == 3
    assert seen.get["channel_is_known_unknown"] == 1 and seen.get["qty_not_negative_failed"] == 1


def test_tolerance(spark):
    cols = "item_code STRING, adi DOUBLE, cv2 DOUBLE, mean_qty DOUBLE"
    target = spark.createDataFrame([("a", 1.0, 0.0, 10.0), ("b", 2.0, 1.0, 10.0)], cols)
    measured = spark.createDataFrame([("a", 1.25, 0.0, 12.0), ("b", 2.6, 1.3, 7.0)], cols)
    got = rows(quality.tolerance_check(measured, target).select("item_code", "adi_ok", "cv2_ok", "mean_qty_ok", "all_ok"))
    assert got == [("a", True, True, True, True), ("b", False, True, False, False)]


def test_safety_stock(spark):
    df = ship(spark, {("A", "DOM"): [0, 0, 10, 20]}).select(F.col("item_code"), "ym", "qty")
    got = rows(inventory.safety_stock(df, ["item_code"]).select("ym", "safety_stock_qty"), "ym")
    assert [g[1] for g in got] == [0, 0, 5, 11]
    items = spark.createDataFrame([("A", D(2020, 3, 31))], "item_code STRING, launch_ym DATE")
    planned = inventory.planned_safety_stock(
        ship(spark, {("A", "DOM"): [0, 0, 10, 20]}), items, {"DOM": {"TOKYO_DC": 0.6, "OSAKA_DC": 0.4}})
    got = rows(planned.select("site_code", "ym", "safety_stock_qty"), "site_code", "ym")
    assert [g[2] for g in got if g[0] == "TOKYO_DC"] == [0, 0, 9, 14]
    assert [g[2] for g in got if g[0] == "OSAKA_DC"] == [0, 0, 6, 9]


def view(spark):
    fact = spark.createDataFrame(
        [("a", "DOM", 1, 10), ("a", "EXP", 2, 20), ("z", "DOM", 1, 5)], "item STRING, channel STRING, month INT, qty INT")
    items = spark.createDataFrame([("a", "cat")], "code STRING, category STRING")
    return metricview.MetricView(
        fact=fact, lookups={"item": metricview.Lookup(items, "item", "code")},
        dimensions={"category": metricview.Dimension("category", "item"), "channel": metricview.Dimension("channel")},
        measures={"qty": F.sum("qty"), "months": F.count_distinct("month")},
        ratios={"per_month": ("qty", "months")}, labels={"category": "品目カテゴリ", "per_month": "月平均"})


def test_metric_view(spark):
    v = view(spark)
    assert rows(v.query(["category"], ["qty", "per_month"])) == [(None, 5, 5.0), ("cat", 30, 15.0)]
    assert rows(v.query(["品目カテゴリ"], ["月平均"])) == [(None, 5.0), ("cat", 15.0)]
    assert v.query(["品目カテゴリ"], ["月平均"]).columns == ["品目カテゴリ", "月平均"]
    assert rows(v.query([], ["qty"], where=lambda d: d("category") == "cat")) == [(30,)]
    with pytest.raises(KeyError, match="nothing"):
        v.query(["nothing"], ["qty"])


def test_metric_view_joins_only_what_it_needs(spark):
    plan = view(spark).query(["channel"], ["qty"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_demand_class_does_not_depend_on_the_partitioning(spark, star):
    from demandloom.operators import demand

    def classes(partitions, adaptive):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        return sorted(map(tuple, demand.classify(star.sparse_shipments, ["item_code"]).select("item_code", "cv2", "demand_class").collect()))

    try:
        first = classes("1", "true")
        assert first and all(classes(n, a) == first for n in ("7", "32") for a in ("true", "false"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


class HandMade:
    """Facts and dimensions of two items, one of which was never exported, and stock at three sites."""

    def __init__(self, spark):
        months = month_ends(dt.date(2024, 1, 31), 3)
        self.last_month = self.last_stock_month = F.lit(months[-1]).cast("date")
        lines = [("A", "DOM", months[0], 4, 40), ("A", "DOM", months[2], 5, 50), ("B", "DOM", months[1], 9, 90), ("B", "EXP", months[1], 1, 10)]
        self.fct_shipments = spark.createDataFrame(lines, "item_code STRING, channel STRING, ym DATE, qty INT, amount BIGINT")
        self.dim_item = spark.createDataFrame(
            [("A", "Item A", "c", "main", 10, "lumpy", 1.5, 0.6, True, months[0]), ("B", "Item B", "c", "main", 10, "erratic", 1.0, 0.6, False, months[1])],
            spec.SOURCES["items"].schema)
        stock = [("A", "S1", months[2], 9, 4, 0, 5), ("B", "S1", months[2], 1, 4, 0, -3), ("A", "S2", months[2], 0, 4, 1, -4),
                 ("A", "S3", months[1], 99, 4, 0, 95), ("B", "S3", months[2], 4, 4, 0, 0)]
        self.fct_inventory = spark.createDataFrame(
            stock, "item_code STRING, site_code STRING, ym DATE, closing_qty INT, safety_stock_qty INT, stockout_flag INT, surplus_qty INT")


def test_reports_of_items_never_exported_and_of_surplus_sites(spark):
    from demandloom.plans import reports

    gold = HandMade(spark)
    assert rows(reports.domestic_items(gold)) == [("A", "Item A", 4.5)]
    assert rows(reports.surplus_sites(gold)) == [("S1", 2)]
    profile = {r["demand_class"] for r in reports.class_profile(gold).collect()}
    assert profile == {"lumpy", "erratic"}
