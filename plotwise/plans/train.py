"""Training, comparing and applying the price models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.functions import display, fixed, numbers
from plotwise.operators import features, least_squares, metrics
from plotwise.operators.least_squares import LinearModel
from plotwise.session import ensure_checkpoints
from plotwise.sources.runs import exists

# Rows of a part that trees are grown from, at least, and about at most.
PART_ROWS, MOST_ROWS = 32_768, 524_288

LINEAR, FOREST, BOOSTING = "Linear Regression", "Random Forest", "Gradient Boosting"


@dataclass(frozen=True)
class ModelSettings:
    """Sizes of the models; the defaults are those of a full run."""

    forest_trees: int = 100
    forest_depth: int = 30     # the most that Spark allows
    boosting_rounds: int = 200
    boosting_depth: int = 3
    boosting_step: float = 0.1
    max_bins: int = 32         # split candidates of a numeric input
    seed: int = 42
    bootstrap: bool = True     # whether each tree sees a sample with repeats


@dataclass
class Trained:
    evaluation: DataFrame          # model, rank, MAE, RMSE, R2
    best_name: str
    model: PipelineModel | LinearModel  # the best one, from input columns to a prediction
    importances: DataFrame | None  # feature, importance; None for the linear model
    scored: DataFrame              # test rows with one prediction column per model


def tree_regressors(s: ModelSettings) -> dict:
    common = {"featuresCol": "features", "labelCol": features.TARGET}
    return {
        FOREST: RandomForestRegressor(numTrees=s.forest_trees, maxDepth=s.forest_depth, maxBins=s.max_bins,
                                      featureSubsetStrategy="all", seed=s.seed, bootstrap=s.bootstrap,
                                      maxMemoryInMB=256, **common),
        BOOSTING: GBTRegressor(maxIter=s.boosting_rounds, maxDepth=s.boosting_depth, stepSize=s.boosting_step,
                               maxBins=s.max_bins, seed=s.seed, checkpointInterval=50, **common),
    }


def parts_for(rows: int, have: int, cores: int) -> int:
    """Parts to grow trees from: one for each core if that pays, and so many that none grows with the table."""
    most, least = -(-rows // PART_ROWS) or 1, -(-rows // MOST_ROWS)
    return max(least, min(most, max(have, cores)))


def whole_turns(parts: int, cores: int) -> int:
    """As many parts, or a few more, so that in the last turn of a pass no core waits for the others: a forest and its boosting make hundreds."""
    return -(-parts // cores) * cores if parts > cores else parts


def alike_together(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each part in the order of ``columns``: rows that are alike take the same ways through trees, and find them in the processor's cache."""
    return rows.sortWithinPartitions(*columns) if columns else rows


def train_and_evaluate(table: DataFrame, settings: ModelSettings = ModelSettings(), key: str = "id",
                       names: list[str] | None = None, numeric: Sequence[str] = features.NUMERIC,
                       categorical: Sequence[str] = features.CATEGORICAL, levels_from_train: bool = False) -> Trained:
    """Fit the models on the train side, measure them on the test side, keep the best R2.

    ``table`` is a training table (``features.training_table``). It is kept in memory with
    spilling, since every boosting round reads it. The linear model takes one aggregate of the
    inputs as they are; vectors are made for the trees only. ``levels_from_train`` leaves the test
    side out when levels are learned.
    """
    ensure_checkpoints(table.sparkSession)
    names = [LINEAR, FOREST, BOOSTING] if names is None else names
    columns = {name: f"prediction_{i}" for i, name in enumerate(names)}
    rows = features.with_split(table, key).select(*dict.fromkeys([key, *numeric, *categorical, features.TARGET, "is_train"]))
    known = rows.filter("is_train") if levels_from_train else rows
    trees = {name: regressor for name, regressor in tree_regressors(settings).items() if name in names}
    feature_model = features.fit_features(known, numeric, categorical) if trees else None
    if trees:
        rows = feature_model.transform(rows).select(*rows.columns, "features")
        # Every tree level reads the vectors again in a short job, so they are dealt out once, in as many parts as pay.
        have = rows.rdd.getNumPartitions()
        cores = table.sparkSession.sparkContext.defaultParallelism
        parts = whole_turns(parts_for(rows.count(), have, cores), cores)
        # Parts of files differ in their rows, and every pass would wait for the largest.
        rows = rows.coalesce(parts) if parts < have else rows.repartition(parts, key) if parts > 1 else rows
        if parts > 1:
            rows = alike_together(rows, [*categorical, *numeric, key])
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    train, scored = rows.filter("is_train"), rows.filter("not is_train")
    fitted = {}
    for name in names:
        if name == LINEAR:
            model = least_squares.fit(train, numeric, features.levels_of(known, categorical) if categorical else {}, features.TARGET)
            fitted[name] = model
            scored = replace(model, output=columns[name]).transform(scored)
        else:
            fitted[name] = trees[name].setPredictionCol(columns[name]).fit(train)
            scored = fitted[name].transform(scored)
    evaluation = metrics.metrics(scored, features.TARGET, columns)
    # At most one row per model reaches the driver.
    evaluation = table.sparkSession.createDataFrame(evaluation.collect(), evaluation.schema)
    best = metrics.best_model(evaluation).first()["model"]
    rows.unpersist()

    if best == LINEAR:
        return Trained(evaluation, best, fitted[best], None, scored)
    model = fitted[best].setPredictionCol("prediction")
    pairs = zip(features.feature_names(feature_model, numeric, categorical), model.featureImportances.toArray().tolist())
    importances = table.sparkSession.createDataFrame(list(pairs), "feature string, importance double")
    return Trained(evaluation, best, PipelineModel([*feature_model.stages, model]), importances, scored)


# The linear model is a text file in this folder of a model's path.
LINEAR_FILE = "least_squares"


def save_model(model: PipelineModel | LinearModel, path: str) -> None:
    if isinstance(model, LinearModel):
        model.save(SparkSession.active(), f"{path}/{LINEAR_FILE}")
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | LinearModel:
    spark = SparkSession.active()
    return LinearModel.load(spark, f"{path}/{LINEAR_FILE}") if exists(spark, f"{path}/{LINEAR_FILE}") else PipelineModel.load(path)


def complete_inputs(inputs: DataFrame) -> DataFrame:
    """Estimate inputs with defaults for what is missing; a new listing is 0 days old."""
    have = set(inputs.columns)
    filled = {c: F.coalesce(F.col(c), F.lit(v)) if c in have else F.lit(v)
              for c, v in fixed.ESTIMATE_DEFAULTS.items()}
    return inputs.withColumns({**filled, "age_days": F.lit(0)})


def score(inputs: DataFrame, model: PipelineModel | LinearModel | None, evaluation: DataFrame | None = None) -> DataFrame:
    """Price estimates for a table of inputs: by the model, or by the rule without one."""
    rows = complete_inputs(inputs)
    kept = [*inputs.columns]
    if model is None:
        estimate = numbers.rule_estimate(*[F.col(c) for c in ("area_sqm", "property_type", "zone", "has_bts")])
        priced = rows.withColumn("predicted_price", estimate)
        info = F.lit(fixed.ESTIMATE_LABEL)
    else:
        if isinstance(model, PipelineModel):
            # A forest takes long for a row, and a small file is read by one task.
            cores = rows.sparkSession.sparkContext.defaultParallelism
            rows = rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
            rows = alike_together(rows, [c for c in (*features.CATEGORICAL, *features.NUMERIC) if c in rows.columns])
        priced = model.transform(rows).withColumn("predicted_price", F.col("prediction"))
        best = metrics.best_model(evaluation).first() if evaluation is not None else None
        info = (display.model_label(F.lit(best["model"]), F.lit(best["R2"])) if best
                else F.lit("Unknown (R² = 0.0000)"))
    return priced.select(*kept, "predicted_price", display.price_text(F.col("predicted_price")).alias("formatted_price"),
                         info.alias("model_info"))

