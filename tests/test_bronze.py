"""Incremental ingest of landing files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import rows
from demandloom import spec
from demandloom.plans.silver import clean
from demandloom.streaming import bronze
from demandloom.streaming.bronze import full_refresh, ingest_all, ingest_stream

SHIPMENTS = spec.SOURCES["shipments"]


def put(landing: str, feed: str, name: str, *lines: str) -> str:
    path = f"{landing}/{feed}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", encoding="utf-8") as f:
        f.write(",".join(spec.SOURCES[feed].columns) + "\n" + "".join(x + "\n" for x in lines))
    return f"{path}/{name}"


def test_exactly_once_per_file_name(spark, database, folder):
    landing, table = f"{folder}/landing", f"{database}.bronze_shipments"

    def run():
        ingest_stream(spark, landing, SHIPMENTS, table, f"{folder}/progress")
        return spark.table(table).count()

    path = put(landing, "shipments", "a.csv", "K1,DOM,2024-01-01,5", "K1,EXP,2024-01-01,2")
    assert run() == 2
    assert run() == 2
    with open(path, "a", encoding="utf-8") as f:
        f.write("K2,DOM,2024-01-31,9\n")
    assert run() == 2, "a known name is not read again, even when it grew"
    put(landing, "shipments", "b.csv", "K1,DOM,2024-01-31,6", "K1,EXP,2024-01-31,2", "K2,DOM,2024-01-31,9")
    assert run() == 5
    first = spark.table(table).select("_source_file", "_source_modified_at", "_ingested_at").first()
    assert first[0].endswith(".csv") and first[1] is not None and first[2] is not None

    silver = clean(spark.table(table), "shipments")
    assert rows(silver.select("item_code", "channel", F.col("ym").cast("string"), "qty")) == [
        ("K1", "DOM", "2024-01-31", 6), ("K1", "EXP", "2024-01-31", 2), ("K2", "DOM", "2024-01-31", 9)]


def test_full_refresh_reads_every_file_again(spark, database, folder):
    landing, table, progress = f"{folder}/landing", f"{database}.bronze_shipments", f"{folder}/progress"
    path = put(landing, "shipments", "a.csv", "K1,DOM,2024-01-31,5")
    ingest_stream(spark, landing, SHIPMENTS, table, progress)
    with open(path, "a", encoding="utf-8") as f:
        f.write("K2,DOM,2024-01-31,9\n")
    ingest_stream(spark, landing, SHIPMENTS, table, progress)
    assert spark.table(table).count() == 1
    full_refresh(spark, landing, SHIPMENTS, table, progress)
    assert spark.table(table).count() == 2
    ingest_stream(spark, landing, SHIPMENTS, table, progress)
    assert spark.table(table).count() == 2


def test_bad_values_keep_their_row(spark, database, folder):
    landing, table = f"{folder}/landing", f"{database}.bronze_shipments"
    put(landing, "shipments", "a.csv", "K1,DOM,bad,5", "K1,DOM,2024-01-31,6")
    ingest_stream(spark, landing, SHIPMENTS, table, f"{folder}/progress")
    kept = spark.table(table).filter(F.col("ym").isNull()).select("item_code", "qty", spec.CORRUPT).collect()
    assert [tuple(r) for r in kept] == [("K1", 5, "K1,DOM,bad,5")]


def put_raw(folder: str, name: str, *lines: str) -> None:
    os.makedirs(f"{folder}/landing/shipments", exist_ok=True)
    with open(f"{folder}/landing/shipments/{name}", "w", encoding="utf-8") as f:
        f.write("".join(x + "\n" for x in lines))


def test_files_of_other_layouts_go_by_name(spark, database, folder):
    table = f"{database}.bronze_shipments"

    def run():
        ingest_stream(spark, f"{folder}/landing", SHIPMENTS, table, f"{folder}/progress")
        return rows(spark.table(table).select("item_code", "channel", F.col("ym").cast("string"), "qty", bronze.REST, spec.CORRUPT), "item_code")

    put_raw(folder, "a.csv", "item_code,channel,ym,qty", "K1,DOM,2024-01-31,5")
    put_raw(folder, "reordered.csv", "\ufeffchannel,qty,item_code,ym", "DOM,6,K2,2024-01-31", "EXP,7,K3,2024-01-31")
    put_raw(folder, "added.csv", "item_code,channel,colour,ym,qty,weight", 'K4,DOM,"red, dark",2024-01-31,8,1.5', "K5,DOM,,2024-01-31,9,heavy")
    put_raw(folder, "missing.csv", "", "item_code,channel,ym", "K6,DOM,2024-01-31")
    expected = [
        ("K1", "DOM", "2024-01-31", 5, None, None), ("K2", "DOM", "2024-01-31", 6, None, None), ("K3", "EXP", "2024-01-31", 7, None, None),
        ("K4", "DOM", "2024-01-31", 8, {"colour": "red, dark", "weight": "1.5"}, None),
        ("K5", "DOM", "2024-01-31", 9, {"weight": "heavy"}, None), ("K6", "DOM", "2024-01-31", None, None, None)]
    assert run() == expected
    put_raw(folder, "later.csv", "qty,item_code,channel,ym,qty", "1,K7,DOM,2024-02-29,2", "1,K8,DOM", "x,K9,DOM,2024-02-29,2")
    got = run()
    assert got[:6] == expected and got[6] == ("K7", "DOM", "2024-02-29", 1, {"qty (5)": "2"}, None)
    assert got[7] == ("K8", "DOM", None, 1, None, "1,K8,DOM") and got[8][3:] == (None, {"qty (5)": "2"}, "x,K9,DOM,2024-02-29,2")

    wide = bronze.promoted(spark.table(table), "colour STRING, weight DOUBLE").filter("item_code IN ('K1', 'K4', 'K5')")
    assert rows(wide.select("item_code", "colour", "weight", bronze.REST), "item_code") == [
        ("K1", None, None, None), ("K4", "red, dark", 1.5, None), ("K5", None, None, {"weight": "heavy"})]
    assert clean(spark.table(table), "shipments").count() == 9


def test_a_file_without_the_key_keeps_its_lines(spark, database, folder):
    table = f"{database}.bronze_shipments"
    put_raw(folder, "a.csv", "K0,DOM,2024-01-31,5", "K1,DOM,2024-01-31,5")
    put_raw(folder, "b.csv", "item_code,channel,ym,qty")
    ingest_stream(spark, f"{folder}/landing", SHIPMENTS, table, f"{folder}/progress")
    assert rows(spark.table(table).select("item_code", spec.CORRUPT)) == [(None, "K1,DOM,2024-01-31,5")]


def test_a_repeated_batch_replaces_what_it_wrote(spark, database, folder):
    table = f"{database}.bronze_shipments"
    put_raw(folder, "a.csv", "item_code,channel,ym,qty", "K1,DOM,2024-01-31,5")
    ingest_stream(spark, f"{folder}/landing", SHIPMENTS, table, f"{folder}/progress")
    label = spark.table(table).select(bronze.BATCH).first()[0]
    kept = spark.table(table).drop(bronze.BATCH, bronze.INGEST_DAY)
    again = spark.createDataFrame(kept.collect(), kept.schema).withColumn("_ingested_at", F.expr("_ingested_at + INTERVAL 3 DAYS"))
    bronze._write_once(again, table, label)
    assert spark.table(table).count() == 1
    bronze._write_once(again, table, "other-0")
    assert spark.table(table).count() == 2


def test_all_six_feeds(spark, database, folder):
    landing = f"{folder}/landing"
    put(landing, "shipments", "a.csv", "K1,DOM,2024-01-31,5")
    put(landing, "items", "a.csv", "K1,Name,Cat,main,100,smooth,1.0,0.2,false,2020-01-01")
    put(landing, "channels", "a.csv", "DOM,国内,\"domestic, direct\"")
    put(landing, "inventory", "a.csv", "K1,S1,2024-01-15,3,4,0")
    put(landing, "lead_time", "a.csv", "K1,S1,7")
    put(landing, "forecast_baseline", "a.csv", "K1,DOM,2024-01-01,2023-12-01,m,5,3,8")
    tables = ingest_all(spark, landing, database, f"{folder}/progress")
    assert len(tables) == 6 and all(spark.table(t).count() == 1 for t in tables)
    silver = {f: clean(spark.table(f"{database}.bronze_{f}"), f) for f in spec.SOURCES}
    assert rows(silver["items"].select("unit_price", "is_domestic_only", F.col("launch_ym").cast("string"))) == [
        (100, False, "2020-01-31")]
    assert rows(silver["channels"]) == [("DOM", "国内", "domestic, direct")]
    assert rows(silver["forecast_baseline"].select(F.col("target_ym").cast("string"), "p50")) == [("2024-01-31", 5.0)]
    for feed in spec.SOURCES:
        expected = spec.SOURCES[feed].columns + (["_source_file", "_ingested_at"] if feed == "shipments" else [])
        assert silver[feed].columns == expected
