"""Bindings against independently measured values, and queries against their SQL."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from check_oracle import check, connect
from demandloom.plans.gold import Gold
from demandloom.sources.star_schema import StarSchema

# one query per kind of operator; FULL_ORACLE=1 runs them all
SAMPLE = ("accuracy_by_class", "silver_shipments", "silver_items", "dedup_lineitem", "dq_counts", "tolerance_check",
          "fct_shipments", "fct_inventory", "densify", "demand_class", "safety_stock", "baseline_naive", "baseline_future",
          "accuracy_all", "accuracy_by_model_common", "vs_baseline", "class_judge", "inventory_health",
          "mv_demand_by_category", "mv_accuracy_by_class", "features_roll", "split_counts", "promotion_rule",
          "best_models", "routed_forecasts", "group_forecast_seasonal", "messy_ingest", "reconcile_counts")


def test_measured_values(star):
    ship = star.shipments
    assert star.sparse_shipments.count() == 5_260
    assert rows(ship.agg(F.count("*"), F.count_if(F.col("qty") == 0), F.sum("qty"), F.count_distinct("ym"))) == [
        (26_076, 20_816, 151_982, 82)]
    assert rows(ship.groupBy("channel").count()) == [("DOM", 8_692), ("EXP", 8_692), ("RET", 8_692)]
    assert rows(star.items.agg(F.count("*"), F.sum("unit_price"), F.count_if("is_domestic_only"))) == [(106, 96_159, 0)]
    assert dict(rows(star.items.groupBy("demand_class").count())) == {
        "smooth": 3, "erratic": 1, "intermittent": 71, "lumpy": 31}
    history = star.forecast_baseline.filter("target_ym <= DATE'2001-10-31'")
    assert rows(history.agg(F.count("*"), F.sum("p50"), F.sum("lower_bound"), F.sum("upper_bound"))) == [
        (22_260, 130_087.0, 78_065.0, 196_235.0)]
    scored = Gold(star).fct_forecast_accuracy.agg(
        F.sum("abs_error"), F.count("ape"), F.round(F.avg("ape"), 6), F.sum("within_interval"))
    assert rows(scored) == [(217_388.0, 4_527, 1.223421, 14_763)]
    assert star.inventory.agg(F.sum("closing_qty")).first()[0] == 75_509
    assert rows(star.lead_time.agg(F.count("*"), F.min("standard_lead_time_days"), F.max("standard_lead_time_days"))) == [
        (528, 1, 10)]
    assert star.bronze_shipments.count() == 5_680


def test_part_grain_conserves_quantity(spark, star):
    fine = StarSchema(spark, SMALL, grain="part").sparse_shipments
    assert fine.agg(F.sum("qty")).first()[0] == star.sparse_shipments.agg(F.sum("qty")).first()[0]
    with pytest.raises(ValueError):
        StarSchema(spark, SMALL, grain="order")


def test_months_follow_the_data(spark, folder):
    """Newer lines count as soon as their month is complete, or as `as_of` says."""
    spark.read.parquet(f"{SMALL}/part.parquet").write.parquet(f"{folder}/part.parquet")
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    newer = lines.limit(50).withColumn("l_shipdate", F.lit("2002-01-31").cast("timestamp_ntz"))
    lines.unionAll(newer).write.parquet(f"{folder}/lineitem.parquet")
    total = lines.unionAll(newer).agg(F.sum("l_quantity")).first()[0]
    star = StarSchema(spark, folder)
    assert Gold(star).fct_shipments.agg(F.sum("qty"), F.max("ym").cast("string")).first() == (total, "2002-01-31")
    early = StarSchema(spark, folder, as_of="2001-11-20").sparse_shipments
    complete = lines.filter("l_shipdate < TIMESTAMP_NTZ'2001-11-01'").agg(F.sum("l_quantity")).first()[0]
    assert early.agg(F.sum("qty")).first()[0] == complete


def test_scan_reads_only_what_it_needs(star):
    plan = star.sparse_shipments._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "lineitem" in line)
    assert "LessThan(l_shipdate" in scan
    read = scan.split("ReadSchema: struct<")[1]
    assert {c.split(":")[0] for c in read.split(">")[0].split(",")} == {
        "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"}


def test_a_hot_part_is_split(spark, folder):
    """A third of all lines on one part: same totals, and the join splits that part's partition."""
    for name in ("part", "lineitem"):
        df = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "lineitem":
            df = df.unionAll(df).unionAll(df.withColumn("l_partkey", F.lit(7).cast("bigint")))
            df = df.unionAll(df).unionAll(df).repartition(8)
        df.write.parquet(f"{folder}/{name}.parquet")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").filter("l_shipdate < TIMESTAMP_NTZ'2001-11-01'")
    hot = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in hot}
    for k, v in hot.items():
        spark.conf.set(k, v)
    try:
        ship = StarSchema(spark, folder).sparse_shipments
        total = sum(r["qty"] for r in ship.collect())
        plan = ship._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    part = spark.read.parquet(f"{folder}/part.parquet")
    kept = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    assert total == kept.agg(F.sum("l_quantity")).first()[0]
    assert "skew=true" in plan


@pytest.fixture(scope="module")
def registered():
    import __spark_entry__ as entry

    return entry, connect(SMALL)


def test_every_statement_has_a_query(registered):
    entry, _con = registered
    assert set(entry.oracle_sql()) <= set(entry.queries())


def names():
    import __spark_entry__ as entry

    return sorted(entry.oracle_sql()) if os.environ.get("FULL_ORACLE") else SAMPLE


@pytest.mark.parametrize("name", names())
def test_query_equals_its_sql(spark, registered, name):
    entry, con = registered
    assert check(spark, con, SMALL, name, entry.queries()[name], entry.oracle_sql()[name]) == []
