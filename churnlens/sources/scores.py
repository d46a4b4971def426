"""Scores of classifiers and the choice made from them, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.sources.events import write_table

SCORE_SCHEMA = "classifier string, weighted boolean, f1 double"


def write_score(spark: SparkSession, path: str, classifier: str, weighted: bool, f1: float) -> DataFrame:
    """Replace the score of one classifier in the score table, which is partitioned by
    ``classifier`` and ``weighted``. Other partitions are not touched, so several
    classifiers may be trained at the same time."""
    row = spark.createDataFrame([(f1,)], "f1 double").coalesce(1)
    return write_table(row, f"{path}/classifier={classifier}/weighted={str(weighted).lower()}")


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """All scores written so far."""
    return spark.read.schema(SCORE_SCHEMA).parquet(path).select("classifier", "weighted", "f1")


def comparable_scores(scores: DataFrame) -> DataFrame:
    """The scores models are compared by: those of class-weighted training."""
    return scores.where(F.col("weighted"))


def write_choice(choice: DataFrame, path: str) -> DataFrame:
    return write_table(choice.coalesce(1), path)


def read_choice(spark: SparkSession, path: str) -> str:
    """Name of the chosen classifier."""
    return spark.read.parquet(path).first()["classifier"]
