"""Named tables and landing files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from demandloom.sources import landing, tables


def test_replace_append_and_evolve(spark, database):
    name = f"{database}.t"
    tables.replace_table(spark.range(3).withColumn("v", F.lit("a")), name, "説明 'quoted'")
    assert spark.table(name).count() == 3
    tables.append_table(spark.range(2).select(F.lit("b").alias("v"), "id"), name)
    assert rows(spark.table(name).groupBy("v").count()) == [("a", 3), ("b", 2)]
    with pytest.raises(ValueError, match="evolve"):
        tables.replace_table(spark.range(1), name)
    tables.replace_table(spark.range(1), name, evolve=True)
    assert spark.table(name).columns == ["id"]
    tables.append_table(spark.range(1), f"{database}.fresh")
    assert tables.existing(spark, [name, f"{database}.fresh", f"{database}.missing"]) == [name, f"{database}.fresh"]


def test_layout_lets_readers_skip(spark, database):
    name = f"{database}.laid_out"
    df = spark.range(0, 20000, 1, 8).select((F.col("id") % 100).cast("int").alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.replace_table(df, name, cluster_by=["k", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = spark.table(name).groupBy(F.col("_metadata.file_path")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    ordered = spans.orderBy("lo").collect()
    assert len(ordered) > 1
    assert all(a["hi"] <= b["lo"] for a, b in zip(ordered, ordered[1:]))


def test_comments_collect_failures(spark, database):
    tables.replace_table(spark.range(1), f"{database}.a")
    done, failed = tables.apply_comments(spark, database, {"a": "one", "gone": "two"})
    assert done == 1 and len(failed) == 1 and failed[0].startswith("gone: ")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.a").filter("col_name = 'Comment'").first()
    assert described["data_type"] == "one"


def test_reconcile_two_databases(spark, database):
    other = f"{database}_ref"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {other}")
    tables.replace_table(spark.range(3), f"{database}.x")
    tables.replace_table(spark.range(3), f"{other}.x")
    tables.replace_table(spark.range(2), f"{database}.y")
    out = tables.reconcile(spark, ["x", "y"], database, other)
    assert rows(out) == [("x", 3, 3, True), ("y", 2, -1, False)]


def test_load_sets_are_disjoint_and_complete(star):
    ship = star.sparse_shipments
    a, b = (landing.split_load_set(ship, "2001-10-31", s) for s in "AB")
    assert a.count() + b.count() == ship.count() == landing.split_load_set(ship, "2001-10-31").count()
    assert a.intersect(b).count() == 0
    with pytest.raises(ValueError):
        landing.split_load_set(ship, "2001-10-31", "C")


def test_landing_files_read_back(spark, folder):
    df = spark.createDataFrame([("K1", 5), ("K2", 6)], "item_code STRING, qty INT")
    landing.write_landing(df, f"{folder}/x")
    landing.write_landing(df.limit(1), f"{folder}/x")
    back = spark.read.option("header", True).schema(df.schema).csv(f"{folder}/x")
    assert back.count() == 3


MAPPING = {"商品コード": ("item_code", "text"), "年月": ("ym", "month"), "数量": ("qty", "number")}
LINES = ["商品コード,年月,数量", 'A-100,2024年1月,"2,155"', "A-100,2024年12月,7", "B-310,不明,5",
         "B-310,2024年2月,n/a", 'A-100,2024年1月,"2,155"']


@pytest.mark.parametrize("encoding", ["UTF-8", "Shift_JIS"])
def test_untidy_file(spark, folder, encoding):
    with open(f"{folder}/own.csv", "w", encoding=encoding) as f:
        f.write("\n".join(LINES) + "\n")
    out = landing.ingest_messy(spark, f"{folder}/own.csv", MAPPING, encoding)
    assert rows(out.select("item_code", F.col("ym").cast("string"), "qty", "ym_raw")) == [
        ("A-100", "2024-01-31", 2155, "2024年1月"), ("A-100", "2024-01-31", 2155, "2024年1月"),
        ("A-100", "2024-12-31", 7, "2024年12月"), ("B-310", None, 5, "不明"), ("B-310", "2024-02-29", None, "2024年2月")]
    assert rows(landing.ingest_report(out, ["item_code", "ym"])) == [(5, 2, 1, 1)]
    with pytest.raises(ValueError, match="kind"):
        landing.tidy(out, {"qty": ("qty", "money")})


def test_replaced_partitions_leave_the_others(spark, database):
    name = f"{database}.months"
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v INT, m STRING")
    tables.replace_table(df, name, partition_by="m", cluster_by=["m", "v"])
    tables.replace_partitions(spark.createDataFrame([("b", 20), ("b", 21), ("c", 30)], "m STRING, v INT"), name, ["m", "v"])
    assert rows(spark.table(name).select("m", "v")) == [(None, 3), ("a", 1), ("b", 20), ("b", 21), ("c", 30)]
    tables.replace_partitions(spark.createDataFrame([(None, 4)], "m STRING, v INT"), name)
    assert rows(spark.table(name).select("m", "v"))[0] == (None, 4)
