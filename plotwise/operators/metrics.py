"""Model metrics, choice of the best model, importances."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions import fixed
from plotwise.functions.numbers import rounded


def metrics(scored: DataFrame, target: str, predictions: Mapping[str, str]) -> DataFrame:
    """(model, rank, MAE, RMSE, R2) for several prediction columns in one scan."""
    pairs = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(name).alias("model"), F.col(c).alias("_yhat"))
                      for i, (name, c) in enumerate(predictions.items())])
    rows = scored.select(F.col(target).cast("double").alias("_y"), F.inline(pairs))
    error = F.col("_yhat") - F.col("_y")
    squared = F.sum(error * error)
    return rows.groupBy("model", "rank").agg(
        F.avg(F.abs(error)).alias("MAE"), F.sqrt(F.avg(error * error)).alias("RMSE"),
        (1 - F.try_divide(squared, F.count("_y") * F.var_pop("_y"))).alias("R2"))


def comparison(evaluated: DataFrame) -> DataFrame:
    return evaluated.orderBy(_score().desc(), "rank")


def _score() -> Column:
    """R2 to rank by; an undefined one (NULL or NaN) is the lowest."""
    return F.when(F.isnan("R2") | F.col("R2").isNull(), F.lit(float("-inf"))).otherwise(F.col("R2"))


def best_model(evaluated: DataFrame) -> DataFrame:
    """One row: highest R2, the earlier model on a tie; an undefined R2 ranks last."""
    pick = F.max_by(F.struct("model", "R2"), F.struct(_score(), -F.col("rank")))
    return evaluated.agg(pick.alias("b")).select(F.col("b.model").alias("model"), F.col("b.R2").alias("R2"))


def top_importances(rows: DataFrame, n: int = 15, digits: int = 4) -> DataFrame:
    return (rows.orderBy(F.desc("importance"), "feature").limit(n)
            .select("feature", rounded(F.col("importance"), digits).alias("importance")))


def importances_or_default(spark, rows: DataFrame | None, n: int = 15) -> DataFrame:
    """The trained model's importances, the stock list when there are none."""
    if rows is None or rows.isEmpty():
        rows = spark.createDataFrame(fixed.DEFAULT_IMPORTANCES, "feature string, importance double")
    return top_importances(rows, n)
