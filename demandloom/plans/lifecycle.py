"""One global model over all series: trials, scoring, comparison and promotion.

Features, training and predictions stay distributed. What reaches the driver is the
fitted ensemble and a handful of scalars.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom import spec
from demandloom.functions.calendar import forecast_run_month
from demandloom.functions.series import abs_error, clip0, ratio_interval, share_of
from demandloom.plans.boosting import boosted_grid
from demandloom.session import use_checkpoints


#: tasks of a pass over the training rows, unless spark.demandloom.train.tasks says otherwise
TRAIN_TASKS = 16


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(spec.FEATURES), outputCol="features")


def train_tasks(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.demandloom.train.tasks", str(TRAIN_TASKS)))


@contextmanager
def vectors(frame: DataFrame):
    """Training rows as label and feature vector, held on executors while trees are grown.

    Split candidates are drawn by partition, in row order. So rows are placed by a hash of their
    series into a stated number of partitions and sorted there: the same data and the same number
    give the same trees on any cluster. Every tree level is a job over these partitions; raise
    the number with the number of series.
    """
    placed = frame.repartition(train_tasks(frame), *spec.SERIES).sortWithinPartitions(*spec.SHIPMENT_KEY)
    held = (assembler().transform(placed).select(*spec.SHIPMENT_KEY, F.col("qty").cast("double").alias("label"), "features")
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        yield held
    finally:
        held.unpersist()


def fit(held: DataFrame, params: Mapping) -> PipelineModel:
    """Boosted trees on assembled vectors; the node-id and residual lineage is cut by checkpoints."""
    use_checkpoints(held.sparkSession)
    trees = GBTRegressor(
        maxDepth=int(params["max_depth"]), stepSize=float(params["learning_rate"]),
        maxIter=int(params["max_iter"]), seed=spec.SEED, checkpointInterval=10,
    )
    return PipelineModel([assembler(), trees.fit(held)])


def train(frame: DataFrame, params: Mapping, folder: str | None = None) -> PipelineModel:
    """One model; with a folder, in stages that a later run goes on from."""
    return fit_trials(frame, [{"name": "model", **params}], folder)[params.get("name", "model")]


def predictions(frame: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """One non-negative prediction column per model on the same rows, without joins."""
    out = frame
    for name, model in models.items():
        scored = model.transform(out)
        out = scored.withColumn(name, clip0("prediction")).drop("features", "prediction")
    return out


def compare(frame: DataFrame, names: Iterable[str], actual: str = "qty", naive: str = "lag_12",
            by: Iterable[str] = ()) -> DataFrame:
    """Error of each prediction column on the validation rows and on the recent ones.

    `frame` carries `is_recent` and the predictions. The scaled error divides by the error
    of "same month last year" on the same rows; below 1 beats it. One aggregation in all.
    """
    names, by = list(names), list(by)
    recent = F.col("is_recent")

    def mae(column: str) -> tuple[Column, Column]:
        error = abs_error(F.col(actual), F.col(column))
        return F.avg(error), F.avg(F.when(recent, error))

    base, base_recent = mae(naive)
    columns = [base.alias("_b"), base_recent.alias("_br")]
    for n in names:
        full, newest = mae(n)
        columns += [full.alias(f"_{n}_v"), newest.alias(f"_{n}_r")]
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("name"),
            F.col(f"_{n}_v").alias("mae"), share_of(F.col(f"_{n}_v"), F.col("_b")).alias("mase"),
            F.col(f"_{n}_r").alias("mae_recent"), share_of(F.col(f"_{n}_r"), F.col("_br")).alias("mase_recent"),
            F.col("_b").alias("baseline_mae"), F.col("_br").alias("baseline_mae_recent"),
        ) for n in names
    ])
    return frame.groupBy(*by).agg(*columns).select(*by, F.explode(rows).alias("_c")).select(*by, "_c.*")


def fit_trials(training: DataFrame, grid: Iterable[Mapping], folder: str | None = None) -> dict[str, PipelineModel]:
    """One model per configuration, all on the same cached vectors.

    With a folder all are fitted at once and in stages: what a run that broke off had finished
    there, for the same rows and settings, is not done again.
    """
    with vectors(training) as held:
        if folder:
            return boosted_grid(held, grid, folder, [assembler()], train_tasks(training))
        return {g["name"]: fit(held, g) for g in grid}


def train_trials(frame: DataFrame, grid: Iterable[Mapping] = spec.TRIAL_GRID,
                 folder: str | None = None) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit the grid on the train rows and score it on the valid rows of a split frame."""
    grid = list(grid)
    models = fit_trials(frame.filter(F.col("split") == "train"), grid, folder)
    valid = frame.filter(F.col("split") == "valid")
    scores = compare(predictions(valid, models), models)
    settings = F.create_map(*[x for g in grid for x in (
        F.lit(g["name"]),
        F.struct(F.lit(int(g["max_depth"])).alias("max_depth"), F.lit(float(g["learning_rate"])).alias("learning_rate"),
                 F.lit(int(g["max_iter"])).alias("max_iter")))])
    return models, scores.withColumn("_p", settings[F.col("name")]).select(
        "name", "_p.*", "mae", "mase", "baseline_mae")


def best_trial(trials: DataFrame) -> DataFrame:
    """The configuration with the lowest error."""
    return trials.agg(F.min_by(F.struct(*trials.columns), F.struct("mae", "name")).alias("_b")).select("_b.*")


def batch_score(frame: DataFrame, model: PipelineModel, version: int, run_date: str,
                trained_through: str | Column | None = None) -> DataFrame:
    """Forecast relation of a model version over every row with complete features.

    Has the baseline's columns, so the two can be stacked, plus whether the row lies after
    the months the model was trained on.
    """
    p50 = F.col("p50")
    low, high = ratio_interval(p50, spec.MODEL_RATIO)
    through = F.lit(trained_through).cast("date") if isinstance(trained_through, (str, type(None))) else trained_through
    return predictions(frame, {"p50": model}).select(
        *spec.SERIES, F.col("ym").alias("target_ym"), forecast_run_month(run_date).alias("forecast_run_ym"),
        F.lit(f"{spec.MODEL_PREFIX}{version}").alias("model_name"), p50,
        low.alias("lower_bound"), high.alias("upper_bound"), (F.col("ym") > through).alias("is_out_of_sample"))


def wins(champion_recent, challenger_recent, challenger_mase_recent):
    """The challenger's recent error is smaller and it beats last year's month (columns or numbers)."""
    return (challenger_recent < champion_recent) & (challenger_mase_recent < 1.0)


def decide(scores: DataFrame, champion: str = "champion", challenger: str = "challenger",
           by: Iterable[str] = ()) -> DataFrame:
    """Both recent errors, the challenger's scaled error and the verdict; unknown means keep."""
    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col(column)))

    row = scores.groupBy(*by).agg(
        of(champion, "mae_recent").alias("champion_mae_recent"),
        of(challenger, "mae_recent").alias("challenger_mae_recent"),
        of(challenger, "mase_recent").alias("challenger_mase_recent"))
    verdict = wins(F.col("champion_mae_recent"), F.col("challenger_mae_recent"), F.col("challenger_mase_recent"))
    return row.withColumn("promote", F.coalesce(verdict, F.lit(False)))


def stack_versions(frame: DataFrame, models: Mapping[int, PipelineModel]) -> DataFrame:
    """Every model version re-scored on the same rows."""
    columns = {f"v{n}": m for n, m in models.items()}
    scores = compare(predictions(frame, columns), columns)
    return scores.select(F.substring("name", 2, 9).cast("int").alias("version"), "mae", "mase", "mae_recent", "mase_recent")

