"""Churn labels, the churn rate, and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.constants import CHURN_PAGE
from churnlens.functions.scalars import count_where, flag


def churned(page: str = CHURN_PAGE) -> Column:
    """Aggregate: 1 when the page was ever reached, else 0."""
    return F.max(flag(F.col("page") == page))


def churn_label(events: DataFrame, key: str = "userId", page: str = CHURN_PAGE) -> DataFrame:
    return events.groupBy(key).agg(churned(page).alias("label"))


def churn_rate(labels: DataFrame) -> DataFrame:
    """One row: users, churned users, and their ratio."""
    positive = count_where(F.col("label") == 1)
    users = F.count(F.lit(1))
    return labels.agg(
        users.alias("users"), positive.alias("churned"), F.try_divide(positive, users).alias("churn_rate")
    )


def class_weights(rows: DataFrame, rate: float, output: str = "weights") -> DataFrame:
    """Weight every row by the share of the other class."""
    return rows.withColumn(output, F.when(F.col("label") == 0, F.lit(rate)).otherwise(F.lit(1.0 - rate)))


def with_label(facts: DataFrame, labels: DataFrame, key: str = "userId") -> DataFrame:
    """Per-user facts with the label of the user; both sides are aggregates."""
    return facts.join(labels.select(key, "label"), key)
