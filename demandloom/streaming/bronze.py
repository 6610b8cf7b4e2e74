"""Incremental ingest of landing files into append-only tables."""

from __future__ import annotations

import csv
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom import spec
from demandloom.sources.tables import replace_partitions
from demandloom.spec import SourceSpec

PROGRESS = "ingest.checkpoint"
INGEST_DAY = "_ingested_on"
BATCH = "_batch"
#: columns of a file that its feed does not name: text by name
REST = "_rest"


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    """A property stored on a table, NULL where the table or the property is missing."""
    if not spark.catalog.tableExists(table):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == key).select("value").head()
    return found[0] if found else None


def set_table_property(spark: SparkSession, table: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{value}')")


def bronze_schema(source: SourceSpec) -> T.StructType:
    """Columns of a feed's table: its own, what did not fit, unknown columns, and where and when a row came from."""
    out = T.StructType([*source.schema.fields]).add(spec.CORRUPT, "string").add(REST, T.MapType(T.StringType(), T.StringType()))
    out = out.add("_source_file", "string")
    out = out.add("_source_modified_at", "timestamp") if source.file_time else out
    return out.add("_ingested_at", "timestamp").add(INGEST_DAY, "date").add(BATCH, "string")


def read_landing(spark: SparkSession, landing: str, source: SourceSpec) -> DataFrame:
    """Stream of the lines of the feed's files, with the file that each came from.

    Files never age out, so a late copy of an old file is still picked up.
    """
    lines = spark.readStream.format("text").option("maxFileAge", "36500d").load(f"{landing}/{source.name}")
    return lines.filter(F.trim("value") != "").select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_modified_at"), (F.col("_metadata.file_block_start") == 0).alias("_begins"))


def _field_names(header: str) -> list[str]:
    """Names of a header line; a name that comes again is told apart by its place."""
    names = [n.strip() for n in next(csv.reader([header.lstrip("\ufeff")]))]
    return [n if n not in names[:k] else f"{n} ({k + 1})" for k, n in enumerate(names)]


def _fields(line: str, names: list[str]) -> Column:
    """A line's texts by name, and the line itself where its number of fields is another."""
    places = ", ".join(f"c{k} STRING" for k in range(len(names)))
    row = F.from_csv(line, f"{places}, bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    texts = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[row[f"c{k}"] for k in range(len(names))]))
    return F.struct(texts.alias("texts"), row["bad"].alias("bad"))


def parsed(lines: DataFrame, source: SourceSpec) -> DataFrame:
    """Rows of lines(_line, _source_file, _source_modified_at, _begins), each read by its own file's header.

    Columns go by name, so they may come in another order; a missing one is NULL; one that the feed
    does not name is kept as text in `_rest`, from which `promoted` can take it later. A line keeps its
    text in the corrupt-record column where a value does not fit its type, where it has more or
    fewer fields than its header, or where the file lacks a column of the feed's key.

    The first line of each file is found by a grouped minimum over lines numbered as they are read.
    Files of one layout are read alike: what the driver sees is one header per layout.
    """
    numbered = lines.withColumn("_at", F.monotonically_increasing_id())
    heads = numbered.filter("_begins").groupBy("_source_file").agg(
        F.min(F.struct("_at", "_line")).alias("_head")).select("_source_file", F.col("_head._at").alias("_head_at"), F.col("_head._line").alias("_head"))
    layouts = [r[0] for r in heads.select("_head").distinct().collect()]
    if not layouts:
        return lines.sparkSession.createDataFrame([], bronze_schema(source)).drop(INGEST_DAY, BATCH)
    found, whole = None, None
    for layout in layouts:
        names = _field_names(layout)
        arm, known = F.col("_head") == layout, F.lit(set(source.key) <= set(names))
        found = F.when(arm, _fields("_line", names)) if found is None else found.when(arm, _fields("_line", names))
        whole = F.when(arm, known) if whole is None else whole.when(arm, known)
    rows = (numbered.join(heads, "_source_file").filter("_at <> _head_at")
            .select("*", found.alias("_found"), whole.alias("_whole")))
    texts = F.col("_found.texts")
    typed, misfits = [], F.col("_found.bad").isNotNull() | ~F.col("_whole")
    for field in source.schema.fields:
        text = F.element_at(texts, field.name)
        value = text.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        misfits = misfits | (text.isNotNull() & value.isNull())
    rest = F.map_filter(texts, lambda k, v: ~k.isin(source.columns) & v.isNotNull())
    lineage = ["_source_file", *(["_source_modified_at"] if source.file_time else [])]
    return rows.select(
        *typed, F.when(misfits, F.col("_line")).alias(spec.CORRUPT), F.when(F.size(rest) > 0, rest).alias(REST),
        *lineage, F.current_timestamp().alias("_ingested_at"))


def promoted(bronze: DataFrame, hints: str) -> DataFrame:
    """Bronze rows with columns that a schema hint (as in `colour STRING, weight DOUBLE`) takes out of `_rest`.

    A text that does not fit the hinted type is NULL in the column and stays in `_rest`.
    """
    out = bronze
    for field in T.StructType.fromDDL(hints).fields:
        text = F.element_at(REST, field.name)
        out = out.withColumn(field.name, text.try_cast(field.dataType))
        taken = (F.col(field.name).isNotNull(), F.lit(field.name))
        left = F.map_filter(REST, lambda k, v: ~(taken[0] & (k == taken[1])))
        out = out.withColumn(REST, F.when(F.size(left) > 0, left))
    return out


def _write_once(rows: DataFrame, table: str, label: str) -> None:
    """Put a batch in a folder of its own, which a repeated run of the same batch replaces."""
    spark = rows.sparkSession
    before = spark.sql(f"SHOW PARTITIONS {table}").filter(F.col("partition").endswith(f"/{BATCH}={label}")).head()
    day = F.lit(before[0].split("/")[0].split("=")[1]).cast("date") if before else F.to_date("_ingested_at")
    replace_partitions(rows.withColumns({INGEST_DAY: day, BATCH: F.lit(label)}), table)


def ingest_stream(spark: SparkSession, landing: str, source: SourceSpec, table: str, checkpoints: str) -> None:
    """Append every file not yet seen, then stop.

    Progress is kept per file name: running again adds only new names, and overwriting a
    known one changes nothing. The table remembers its progress folder, so that a full
    refresh can start a new one without touching the old. It is partitioned by ingest day,
    so that what arrived lately can be read without the rest, and by batch, so that a batch
    that broke off while it was written is not there twice when the next run repeats it.
    """
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], bronze_schema(source))
        empty.write.format("parquet").partitionBy(INGEST_DAY, BATCH).saveAsTable(table)
        set_table_property(spark, table, PROGRESS, f"{checkpoints}/{table}-{uuid.uuid4().hex}")
    progress = table_property(spark, table, PROGRESS)
    run = progress.rsplit("-", 1)[-1]
    query = (
        read_landing(spark, landing, source).writeStream
        .option("checkpointLocation", progress).trigger(availableNow=True)
        .foreachBatch(lambda batch, number: _write_once(parsed(batch, source), table, f"{run}-{number}")).start()
    )
    query.awaitTermination()


def full_refresh(spark: SparkSession, landing: str, source: SourceSpec, table: str, checkpoints: str) -> None:
    """Forget progress and load every file again."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    ingest_stream(spark, landing, source, table, checkpoints)


def ingest_all(spark: SparkSession, landing: str, database: str, checkpoints: str) -> list[str]:
    """Run the six feeds to completion; returns the bronze table names."""
    tables = []
    for name, source in spec.SOURCES.items():
        table = f"{database}.bronze_{name}"
        ingest_stream(spark, landing, source, table, checkpoints)
        tables.append(table)
    return tables
