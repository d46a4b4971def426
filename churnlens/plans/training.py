"""Training and comparing classifiers, and using the best one on other data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from churnlens.constants import CLASSIFIER_PRIORITY, SEED, SPLIT
from churnlens.operators.evaluate import (
    best_model,
    classification_report,
    confusion_matrix,
    rank_coefficients,
)
from churnlens.operators.labels import churn_rate, class_weights
from churnlens.operators.materialise import run_scope
from churnlens.operators.models import Trained, hash_split, random_split, train_and_score
from churnlens.plans.features import write_features
from churnlens.plans.prepare import Layout, prepare
from churnlens.sources.events import read_table, write_table
from churnlens.sources.scores import (
    comparable_scores,
    read_choice,
    read_scores,
    write_choice,
    write_score,
)

KEY = "userIdIndex"


def split(rows: DataFrame, how: str, key: str = KEY) -> Sequence[DataFrame]:
    """``hash`` gives the same parts on any cluster, ``random`` is Spark's own."""
    if how == "hash":
        return hash_split(rows, key, SPLIT, SEED)
    if how == "random":
        return random_split(rows, SPLIT, SEED)
    raise ValueError(f"unknown split: {how!r}")


def train(spark: SparkSession, out: Layout, name: str, *, how: str = "hash", **options: int) -> Trained:
    """Train one classifier twice: on whole-log features, then class-weighted on
    the features of both periods. Both scores are written; the predictions of the
    second model are described by a report and a confusion matrix."""
    with run_scope(spark):
        without, full = read_table(spark, out.no_lw_features), read_table(spark, out.features)
        first = train_and_score(*split(without, how), name, **options)
        write_score(spark, out.scores, name, False, first.f1)

        rate = churn_rate(read_table(spark, out.churn)).first()["churn_rate"]
        second = train_and_score(*split(class_weights(full, rate), how), name, "weights", **options)
        write_score(spark, out.scores, name, True, second.f1)

        predictions = write_table(second.predictions.select(KEY, "label", "prediction"), f"{out.predictions}/{name}")
        write_table(classification_report(predictions).coalesce(1), f"{out.class_report}/{name}")
        write_table(confusion_matrix(predictions).coalesce(1), f"{out.confusion}/{name}")
        if name != "random_forest":
            ranked = rank_coefficients(second.coefficients())
            write_table(ranked.coalesce(1), f"{out.coefficients}/{name}")
    return second


def choose(spark: SparkSession, out: Layout, choice_path: str) -> str:
    """Write and return the name of the classifier with the best weighted score."""
    scores = comparable_scores(read_scores(spark, out.scores))
    write_choice(best_model(scores), choice_path)
    return read_choice(spark, choice_path)


def train_all(spark: SparkSession, json_path: str, root: str, choice_path: str, **options: int) -> str:
    """Everything from raw events to the chosen classifier."""
    out = prepare(spark, json_path, root)
    write_features(spark, out)
    for name in CLASSIFIER_PRIORITY:
        train(spark, out, name, **options)
    return choose(spark, out, choice_path)


def run_chosen(spark: SparkSession, json_path: str, root: str, choice_path: str, **options: int) -> Trained:
    """Prepare a second dataset and train the chosen classifier on it."""
    out = prepare(spark, json_path, root)
    write_features(spark, out)
    return train(spark, out, read_choice(spark, choice_path), **options)
