"""Two-pass external shuffle into shards, with DataFrame functions only.

First pass: every record goes to a shard by rendezvous hashing of its doc_id (the shard with the
largest seeded hash wins, so one shard more takes records only into itself) and, by another seeded
hash, to one of the shard's buckets. The number of buckets follows from the bytes of all texts, so
that a bucket fits a task's memory, and bucket k goes to partition k, so that no two meet in a task. Second pass: each bucket is put in a fixed order, shuffled
(Spark's `shuffle` is Fisher-Yates with a given seed) and written to the shared folder. A record's
slot is its place in its bucket plus the sizes of the shard's earlier buckets, which are sent to the
written records (one row a bucket), so that the records are shuffled once.

The law is `key`: doc_id and the number of shards alone decide. A null doc_id is a key like any
other; null texts have no bytes and the checksum of an empty text. Rows that repeat a doc_id share
a shard and are spread over its buckets by their text's checksum; equal rows keep separate slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm import shared

SHARDS = 8
BUCKET_BYTES = 32 << 20
SEED = 7


def rendezvous(key: str, shards: int, seed: int = SEED) -> Column:
    """The shard whose seeded hash of the key is largest."""
    best = F.greatest(*[F.struct(F.xxhash64(key, F.lit(k), F.lit(seed)).alias("h"), F.lit(k).alias("k")) for k in range(shards)])
    return best["k"].cast("int")


def shard(docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """docs with size, text_crc32, law, shard, slot and grown_shard; a column of such a name is replaced."""
    spark = docs.sparkSession
    folder = shared.workspace(spark, "shards")
    added = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    own = [c for c in docs.columns if c.lower() not in added]
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))

    record = F.struct(*[F.col(f"`{c}`") for c in own])
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")
    placed = docs.select(
        record.alias("record"), size.alias("size"), crc.alias("text_crc32"),
        rendezvous("doc_id", shards, seed).alias("shard"), rendezvous("doc_id", shards + 1, seed).alias("grown_shard"))
    spread = F.xxhash64("record.doc_id", "text_crc32", F.lit(seed + 1))
    placed = placed.withColumn("bucket", (F.col("shard") * buckets + F.pmod(spread, F.lit(buckets))).cast("int"))

    n = shards * buckets
    entry = F.struct(F.xxhash64("record.doc_id", "text_crc32", F.lit(seed + 2)).alias("order"), F.xxhash64(*[F.col(f"record.`{c}`") for c in own], F.lit(seed + 3)).alias("tie"),
                     "text_crc32", "size", "shard", "grown_shard", "record")
    gathered = (placed.repartitionById(n, F.col("bucket")).groupBy("bucket")
                .agg(F.collect_list(entry).alias("rows"))
                .select("bucket", F.shuffle(_ordered("rows"), F.lit(seed)).alias("rows"))
                .select("bucket", F.posexplode("rows").alias("place", "row"))
                .select("bucket", "place", "row.*").drop("order", "tie"))
    written = shared.stored_alone(gathered, folder)

    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (written.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
            .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return written.join(F.broadcast(base), "bucket").select(
        "record.*", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("base") + F.col("place")).cast("long").alias("slot"), "grown_shard")


def _ordered(rows: str) -> Column:
    """By seeded hash, checksum and size, then by a hash of the whole record: only equal records tie."""
    def compare(a: Column, b: Column) -> Column:
        less = F.lit(0)
        for name in ("tie", "size", "text_crc32", "order"):
            less = F.when(a[name] < b[name], -1).when(a[name] > b[name], 1).otherwise(less)
        return less
    return F.array_sort(rows, compare)
