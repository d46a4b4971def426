"""Hold-out splits, classifiers, and their training."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.constants import SEED, SPLIT, TREES
from churnlens.operators.assemble import feature_names, max_abs_scaler
from churnlens.operators.evaluate import coefficient_table

_HASH_BITS = 32


def hash_fraction(key: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    digest = F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed))))
    head = F.conv(F.substring(digest, 1, _HASH_BITS // 4), 16, 10).cast("long")
    return head / F.lit(float(1 << _HASH_BITS))


def hash_split(
    rows: DataFrame, key: str, fractions: Sequence[float] = SPLIT, seed: int = SEED
) -> list[DataFrame]:
    """Disjoint parts of ``rows`` by a hash of the key: the same rows in the same
    part however the data is laid out, and after any task is run again."""
    place = hash_fraction(F.col(key), seed)
    parts, low = [], 0.0
    for i, fraction in enumerate(fractions):
        high = low + fraction
        inside = place >= low
        if i < len(fractions) - 1:
            inside = inside & (place < high)
        parts.append(rows.where(inside))
        low = high
    return parts


def random_split(rows: DataFrame, fractions: Sequence[float] = SPLIT, seed: int = SEED) -> list[DataFrame]:
    """Spark's own split; which rows go where depends on the partitions."""
    return rows.randomSplit(list(fractions), seed=seed)


def classifier(name: str, weights: str | None = None, *, trees: int = TREES, seed: int = SEED):
    """An unfitted classifier by name, over ``scaled_features``."""
    shared = {"featuresCol": "scaled_features", "labelCol": "label"}
    if weights is not None:
        shared["weightCol"] = weights
    if name == "random_forest":
        return RandomForestClassifier(numTrees=trees, seed=seed, **shared)
    if name == "logistic_regression":
        return LogisticRegression(**shared)
    if name == "linear_svm":
        return LinearSVC(**shared)
    raise ValueError(f"unknown classifier: {name!r}")


@dataclass(frozen=True)
class Trained:
    name: str
    model: PipelineModel
    predictions: DataFrame
    f1: float

    def coefficients(self) -> DataFrame:
        """Feature names and coefficients of a linear model."""
        names = feature_names(self.predictions)
        return coefficient_table(self.predictions.sparkSession, names, self.model.stages[-1].coefficients)


def train_and_score(
    training: DataFrame, test: DataFrame, name: str, weights: str | None = None, **options: int
) -> Trained:
    """Scale on the training part, fit, predict the test part, and score the
    predictions by weighted F1 (row weights are for training only)."""
    model = Pipeline(stages=[max_abs_scaler(), classifier(name, weights, **options)]).fit(training)
    predictions = model.transform(test)
    f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(predictions)
    return Trained(name, model, predictions, f1)
