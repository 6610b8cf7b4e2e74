"""From raw documents to training shards: the operators of demandloom.llm, one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet to the
shared folder and rereads it as the next one's docs. All but the last return docs' own columns.
Every operator's docstring says what becomes of null and empty texts; rows without a doc_id pass
the near-duplicate stage, as nothing names them. Empty tables pass all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm import decontam, mixture, neardup, quality, shared, shards
from demandloom.session import ship_code

ship_code()


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity the trusted text of their language allows."""
    return quality.without_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates on five-word shingles: the one with the smallest doc_id.

    Of rows that repeat that doc_id the first by a hash of the row stays.
    """
    found = neardup.near_duplicates(docs, width=5)
    stay = found.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    columns = [f"`{c}`" for c in docs.columns]
    kept_id, times, place = shared.fresh(docs, "kept_id", "times", "place")
    stay = stay.select(F.col("doc_id").alias(kept_id), F.col("n").alias(times))
    named = docs.join(stay, F.col("doc_id") == F.col(kept_id))
    once = named.filter(F.col(times) == 1).select(*columns)
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64(*columns))
    again = named.filter(F.col(times) > 1).withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1).select(*columns)
    out = once if stay.filter(F.col(times) > 1).isEmpty() else once.unionByName(again)
    nameless = docs.filter("doc_id IS NULL")
    return out if nameless.isEmpty() else out.unionByName(nameless)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test passage of note."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source near its target: documents left out, taken once, or repeated."""
    return mixture.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, shuffled into shards: docs with shard, slot, size and checksum."""
    return shards.shard(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: a language model's perplexities and seeded draws have no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared.workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = shared.stored(stage(spark, docs, sf_dir), f"{folder}/{k}")
    return docs
