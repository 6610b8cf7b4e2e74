"""Named tables: replace, append, lay out, comment, reconcile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def comment_table(spark: SparkSession, name: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")


def replace_table(df: DataFrame, name: str, comment: str | None = None,
                  cluster_by: Sequence[str] = (), evolve: bool = False, partition_by: str | None = None) -> None:
    """Replace a table by a query result.

    With `cluster_by`, rows are ranged and sorted on those columns before writing, so that
    file statistics let readers skip what a filter on them excludes; with `partition_by`,
    each value of that column gets its own folder, which can be replaced alone. A result
    with other columns than the table is refused unless `evolve` says the schema may change.
    """
    spark = df.sparkSession
    if not evolve and spark.catalog.tableExists(name):
        have, new = spark.table(name).columns, df.columns
        if sorted(have) != sorted(new):
            raise ValueError(f"{name} has columns {have}, not {new}; pass evolve=True to change them")
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    writer = df.write.mode("overwrite").format("parquet")
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(name)
    if comment:
        comment_table(spark, name, comment)


def replace_partitions(df: DataFrame, name: str, cluster_by: Sequence[str] = ()) -> None:
    """Replace the partitions that occur in the result and leave all others as they are."""
    spark = df.sparkSession
    rows = df.select(*spark.table(name).columns)
    if cluster_by:
        rows = rows.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")  # inserting into a table ignores the writer's own option
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def append_table(df: DataFrame, name: str) -> None:
    """Append by column name, creating the table when it does not exist."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df.select(*spark.table(name).columns).write.insertInto(name)
    else:
        df.write.format("parquet").saveAsTable(name)


def existing(spark: SparkSession, names: Sequence[str]) -> list[str]:
    return [n for n in names if spark.catalog.tableExists(n)]


def apply_comments(spark: SparkSession, database: str, comments: Mapping[str, str]) -> tuple[int, list[str]]:
    """Comment each table; returns how many succeeded and what failed, without stopping."""
    failed = []
    for table, comment in comments.items():
        try:
            comment_table(spark, f"{database}.{table}", comment)
        except PySparkException as e:
            failed.append(f"{table}: {e.getCondition() or type(e).__name__}")
    return len(comments) - len(failed), failed


def _counts(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias(column)).select(F.lit(n).alias("relation"), column) for n, df in tables.items()]
    return reduce(DataFrame.unionAll, parts)


def reconcile_counts(mine: Mapping[str, DataFrame], reference: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of two sets of relations side by side; a relation one side lacks counts -1."""
    both = _counts(mine, "n_mine").join(_counts(reference, "n_reference"), "relation", "full")
    both = both.fillna(-1, ["n_mine", "n_reference"])
    return both.withColumn("matches", F.col("n_mine") == F.col("n_reference"))


def reconcile(spark: SparkSession, names: Sequence[str], mine: str, reference: str) -> DataFrame:
    """The same for the tables of two databases."""
    def tables(database: str) -> dict[str, DataFrame]:
        found = existing(spark, [f"{database}.{n}" for n in names])
        return {f.split(".", 1)[1]: spark.table(f) for f in found}

    return reconcile_counts(tables(mine), tables(reference))


# what a stored relation holds: grain, key, units
TABLE_COMMENTS = {
    "fct_shipments": "Key (item_code, channel, ym): pieces shipped and their value; months without shipments are rows of 0.",
    "dim_item": "Key item_code: unit price, measured demand statistics and class, month of first demand, exported or not.",
    "dim_channel": "Key channel_code: name and description of a sales channel.",
    "dim_lead_time": "Key (item_code, site_code): days from order to arrival.",
    "fct_inventory": "Key (item_code, site_code, ym): closing and safety stock in pieces, what exceeds it, 1 if nothing was left.",
    "fct_forecast_baseline": "Key (item_code, channel, target_ym): the same month a year before, else two years before, with bounds.",
    "fct_forecast_accuracy": "Baseline rows that have an actual: absolute error in pieces, error by actual, 1 inside the bounds.",
    "fct_forecast_model": "Key (item_code, channel, target_ym): prediction of one model version, and if the month came after its training.",
    "fct_forecast_ai": "Key (item_code, channel, target_ym, forecast_run_ym): best simple method a series, ahead and on the hidden year.",
    "fct_forecast_accuracy_all": "Rows of fct_forecast_accuracy for each forecast relation, told apart by model_name.",
    "model_version_comparison": "Key version: errors on the newest validation months, one evaluation for all.",
    "best_models": "Key series: the model with the least mean error over the backtest windows, and its route.",
    "evaluation_summary": "Series won, by demand class and model.",
}
