"""Model runs, versions, aliases and tags as append-only tables.

Nothing is updated in place: an alias or tag holds the value of its newest event. One
job at a time writes a registry, as one job at a time trains.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.operators.dedup import latest_by
from demandloom.sources.tables import append_table

#: layout of the registry tables; the last column of each says when a row was added
LAYOUT = {
    "model_runs": "run_id INT, name STRING, max_depth INT, learning_rate DOUBLE, max_iter INT, mae DOUBLE, "
                  "mase DOUBLE, baseline_mae DOUBLE, trained_through DATE, data_available_through DATE, logged_by STRING, logged_at TIMESTAMP",
    "model_versions": "version INT, run_id INT, path STRING, registered_at TIMESTAMP",
    "model_alias_events": "event_no INT, alias STRING, version INT, set_at TIMESTAMP",
    "model_tags": "event_no INT, version INT, tag STRING, value STRING, set_at TIMESTAMP",
}


class Registry:
    """Registry of one model in a database, its files under `root`."""

    def __init__(self, spark: SparkSession, database: str, root: str, model: str = "demand_forecast") -> None:
        self.spark, self.database, self.model = spark, database, model
        self.root = f"{root}/models/{model}"
        for table, layout in LAYOUT.items():
            spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({layout}) USING parquet")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def _next(self, table: str, column: str) -> int:
        return self.table(table).select(F.coalesce(F.max(column), F.lit(0)) + 1).head()[0]

    def _add(self, table: str, values: Mapping) -> None:
        row = self.spark.createDataFrame([tuple(values.values())], ", ".join(
            c for c in LAYOUT[table].split(", ") if c.split(" ")[0] in values))
        stamp = LAYOUT[table].rsplit(", ", 1)[1].split(" ")[0]
        append_table(row.withColumn(stamp, F.current_timestamp()), f"{self.database}.{table}")

    def log_run(self, name: str, params: Mapping, metrics: Mapping, trained_through, available_through=None) -> int:
        run = self._next("model_runs", "run_id")
        self._add("model_runs", {
            "run_id": run, "name": name, "max_depth": int(params["max_depth"]),
            "learning_rate": float(params["learning_rate"]), "max_iter": int(params["max_iter"]),
            "mae": metrics["mae"], "mase": metrics["mase"], "baseline_mae": metrics["baseline_mae"],
            "trained_through": trained_through, "data_available_through": available_through,
            "logged_by": self.spark.range(1).select(F.current_user()).head()[0]})
        return run

    def register(self, model: PipelineModel, run_id: int) -> int:
        """Store the model as the next version."""
        version = self._next("model_versions", "version")
        path = f"{self.root}/v{version}"
        model.write().overwrite().save(path)
        self._add("model_versions", {"version": version, "run_id": run_id, "path": path})
        return version

    def set_alias(self, alias: str, version: int) -> None:
        self._add("model_alias_events", {
            "event_no": self._next("model_alias_events", "event_no"), "alias": alias, "version": version})

    def tag(self, version: int, tags: Mapping[str, object]) -> None:
        for tag, value in tags.items():
            self._add("model_tags", {
                "event_no": self._next("model_tags", "event_no"), "version": version, "tag": tag, "value": str(value)})

    def aliases(self) -> DataFrame:
        newest = latest_by(self.table("model_alias_events"), ["alias"], ["event_no"])
        return newest.select("alias", "version")

    def tags(self) -> DataFrame:
        return latest_by(self.table("model_tags"), ["version", "tag"], ["event_no"]).select("version", "tag", "value")

    def resolve(self, alias: str) -> int | None:
        found = self.aliases().filter(F.col("alias") == alias).head()
        return found["version"] if found else None

    def load(self, version: int) -> PipelineModel:
        path = self.table("model_versions").filter(F.col("version") == version).select("path").head()
        if path is None:
            raise LookupError(f"{self.model} has no version {version}")
        return PipelineModel.load(path[0])

    def run_of(self, version: int) -> dict:
        runs = self.table("model_versions").filter(F.col("version") == version).join(self.table("model_runs"), "run_id")
        return runs.head().asDict()

    def params_of(self, version: int) -> dict:
        """Hyper-parameters a version was trained with, or the defaults where none are recorded."""
        run = self.run_of(version)
        known = {k: run[k] for k in spec.DEFAULT_PARAMS if run.get(k) is not None}
        return known if len(known) == len(spec.DEFAULT_PARAMS) else dict(spec.DEFAULT_PARAMS)

    def versions(self) -> DataFrame:
        """All versions with the metrics of their run and the aliases pointing at them."""
        names = self.aliases().groupBy("version").agg(F.concat_ws(", ", F.array_sort(F.collect_list("alias"))).alias("alias"))
        runs = self.table("model_runs").drop("logged_at")
        return (self.table("model_versions").join(runs, "run_id").join(names, "version", "left")
                .fillna("-", ["alias"]).orderBy("version"))
