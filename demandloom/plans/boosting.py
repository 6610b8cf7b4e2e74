"""Boosted trees in stages that survive a lost driver: each stage's trees and scores are written, and a
later run goes on from the last whole one.

Every tree is one of Spark's own regression trees, grown on what the trees before leave of the
label; the first counts in full, each other one by the learning rate. STAGE trees make a stage. When
one is grown, its trees and then the rows with their scores are written to the stage's folder: a
folder whose rows are complete is a stage that stands. Between stages no plan is kept, so that it never
grows beyond the trees of one stage.

Several settings are fitted at once, each in a scheduler pool of its own, on the same held rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import spec

#: trees of a stage
STAGE = 25
_KEEP = [*spec.SHIPMENT_KEY, "label", "features"]


def fingerprint(rows: DataFrame, params: Mapping) -> str:
    """A name for these rows and settings: equal rows in any order have equal names."""
    word = F.xxhash64(*[F.col(c) for c in rows.columns if c != "features"])
    n, odd, total = rows.agg(F.count("*"), F.bit_xor(word), F.sum(word % 1_000_003)).first()
    setting = "_".join(str(params[k]) for k in ("max_depth", "learning_rate", "max_iter"))
    return f"{params.get('name', 'model')}-{setting}-{n}-{(odd or 0) % 2**64:x}-{(total or 0) % 2**64:x}"


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _placed(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows where and in the order in which they always lie: split candidates are drawn by partition."""
    return rows.repartition(tasks, *spec.SERIES).sortWithinPartitions(*spec.SHIPMENT_KEY)


def _stage(rows: DataFrame, params: Mapping, first: int, last: int) -> tuple[list[DecisionTreeRegressionModel], DataFrame]:
    """Trees first..last-1, and the rows with their scores after them (held; the caller releases them)."""
    trees, now = [], rows.persist(StorageLevel.MEMORY_AND_DISK)
    grower = DecisionTreeRegressor(labelCol="left", maxDepth=int(params["max_depth"]), seed=spec.SEED)
    for k in range(first, last):
        tree = grower.fit(now.select("features", (F.col("label") - F.col("score")).alias("left")))
        trees.append(tree)
        weight = float(params["learning_rate"]) if k else 1.0
        scored = tree.transform(now).withColumn("score", F.col("score") + weight * F.col("prediction")).select(*_KEEP, "score")
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        scored.count()
        now.unpersist()
        now = scored
    return trees, now


def boosted(rows: DataFrame, params: Mapping, folder: str, stage: int = STAGE, tasks: int = 16) -> GBTRegressionModel:
    """A model of params["max_iter"] trees on rows(item_code, channel, ym, label, features), resumed from `folder`."""
    spark, most = rows.sparkSession, int(params["max_iter"])
    trees: list[DecisionTreeRegressionModel] = []
    begin = rows.select(*_KEEP).withColumn("score", F.lit(0.0))
    while len(trees) < most:
        number, last = len(trees) // stage, min(most, (len(trees) // stage + 1) * stage)
        here = f"{folder}/stage-{number}-of-{stage}"
        places = [f"{here}/tree-{k}" for k in range(len(trees), last)]
        if _exists(spark, f"{here}/rows/_SUCCESS"):
            trees += [DecisionTreeRegressionModel.load(p) for p in places]
        else:
            grown, now = _stage(_placed(begin, tasks), params, len(trees), last)
            for tree, place in zip(grown, places):
                tree.write().overwrite().save(place)
            now.write.mode("overwrite").parquet(f"{here}/rows")
            now.unpersist()
            trees += grown
        begin = spark.read.parquet(f"{here}/rows")
    return ensemble(spark, trees, [1.0] + [float(params["learning_rate"])] * (most - 1))


def ensemble(spark: SparkSession, trees: list[DecisionTreeRegressionModel], weights: list[float]) -> GBTRegressionModel:
    """Spark's own model of these trees and weights."""
    gateway, regression = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml.regression
    parts = gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    shares = gateway.new_array(gateway.jvm.double, len(trees))
    for k, (tree, weight) in enumerate(zip(trees, weights)):
        parts[k], shares[k] = tree._java_obj, weight
    return GBTRegressionModel(regression.GBTRegressionModel(f"boosted_{len(trees)}", parts, shares))


def boosted_grid(held: DataFrame, grid: Iterable[Mapping], folder: str, stages: list, tasks: int = 16, stage: int = STAGE) -> dict[str, PipelineModel]:
    """A pipeline of `stages` and the boosted trees for every setting, all fitted at once."""
    grid, context = list(grid), held.sparkSession.sparkContext

    def one(params: Mapping) -> PipelineModel:
        context.setLocalProperty("spark.scheduler.pool", f"trial_{params.get('name', 'model')}")
        return PipelineModel([*stages, boosted(held, params, f"{folder}/{fingerprint(held, params)}", stage, tasks)])

    with ThreadPoolExecutor(len(grid)) as pool:
        runs = {g.get("name", "model"): pool.submit(inheritable_thread_target(one), g) for g in grid}
        return {name: run.result() for name, run in runs.items()}
