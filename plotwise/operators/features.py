"""Model inputs: selection, one-hot columns, repeatable split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions import fixed

NUMERIC = ["area_sqm", "bedrooms", "bathrooms", "floor", "has_bts", "age_days"]
CATEGORICAL = ["zone", "property_type"]
TARGET = "price_thb"
TRAINING_DEFAULTS = {"bedrooms": 1.0, "bathrooms": 1.0, "floor": 1.0, "age_days": 0}


def training_table(df: DataFrame, key: str = "id") -> DataFrame:
    """Inputs and target: land is on floor 0, rows without price or area are left out."""
    rows = df.withColumn("floor", F.when(F.col("property_type") == fixed.LAND, F.lit(0.0)).otherwise(F.col("floor")))
    rows = rows.dropna(subset=[TARGET, "area_sqm"]).fillna(TRAINING_DEFAULTS)
    return rows.select(key, *NUMERIC, *CATEGORICAL, TARGET)


# Levels of a column that a one-hot table accepts.
MAX_LEVELS = 1000


def levels_of(df: DataFrame, columns: Sequence[str] = CATEGORICAL, most: int = MAX_LEVELS) -> dict[str, list]:
    """Sorted distinct values of each column, learned from the data; more than ``most`` of one is an error."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("level")) for c in columns]))
    rows = df.select(cells.alias("cell")).select("cell.*").filter("level is not null").distinct().limit(most * len(columns) + 1).collect()
    found = {c: sorted(r["level"] for r in rows if r["name"] == c) for c in columns}
    if len(rows) > most * len(columns) or any(len(v) > most for v in found.values()):
        raise ValueError(f"a column has more than {most} levels; map its spellings first")
    return found


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[object]] | None = None) -> DataFrame:
    """0/1 columns ``<column>_<level>`` for all levels in the data, or for the given ones; others give all zeros."""
    levels = levels_of(df) if levels is None else levels
    flags = {f"{c}_{v}": F.when(F.col(c) == v, F.lit(1)).otherwise(F.lit(0))
             for c, values in levels.items() for v in values}
    return df.withColumns(flags).drop(*levels)


def split_slot(key: Column) -> Column:
    """0..9 from the key alone, so the split does not depend on the partitioning."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 7), 16, 10).cast("bigint") % 10


def with_split(df: DataFrame, key: str = "id", train_slots: int = 8) -> DataFrame:
    return df.withColumn("is_train", split_slot(F.col(key)) < train_slots)


def feature_stages(numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> list:
    """Alphabetical one-hot of every level; a level unseen in training becomes all zeros.

    The indexer puts unseen levels last, and the encoder drops the last one.
    """
    encoded = []
    stages = []
    if categorical:
        indexers = StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_index" for c in categorical],
                                 handleInvalid="keep", stringOrderType="alphabetAsc")
        encoder = OneHotEncoder(inputCols=indexers.getOutputCols(), outputCols=[f"{c}_vec" for c in categorical],
                                dropLast=True)
        encoded, stages = encoder.getOutputCols(), [indexers, encoder]
    return [*stages, VectorAssembler(inputCols=[*numeric, *encoded], outputCol="features")]


def fit_features(train: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL):
    """Fitted feature stages; a column of more levels than ``MAX_LEVELS`` is an error before any level is indexed."""
    if categorical:
        levels_of(train, categorical)
    return Pipeline(stages=feature_stages(numeric, categorical)).fit(train)


def feature_names(feature_model, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> list[str]:
    """Names in vector order, such as ``zone_CBD``."""
    labels = feature_model.stages[0].labelsArray if categorical else []
    return [*numeric, *[f"{c}_{v}" for c, values in zip(categorical, labels) for v in values]]
