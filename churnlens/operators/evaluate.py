"""Metrics of predictions, model choice, and coefficient rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.constants import CLASSIFIER_PRIORITY, LABELS
from churnlens.functions.scalars import count_where


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def class_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class that occurs as a label or
    as a prediction; a ratio with nothing below the line is 0. With ``by`` columns
    (a classifier's name, say) for each of their values, from one scan.

    Predictions are first counted per (label, prediction), which leaves a handful
    of rows for everything after."""
    cells = predictions.groupBy(*by, F.col("label").cast("int"), F.col("prediction").cast("int")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")),
    )
    totals = cells.select(*by, F.inline(sides)).groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    precision = _or_zero(F.col("hits"), F.col("predicted"))
    recall = _or_zero(F.col("hits"), F.col("support"))
    return totals.select(
        *by,
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        _or_zero(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "hits",
    )


def classification_report(predictions: DataFrame) -> DataFrame:
    """Rows per class, then ``accuracy`` (in ``f1`` only), ``macro avg`` and
    ``weighted avg`` (by support)."""
    classes = class_metrics(predictions)
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    summary = classes.rollup("class").agg(
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[_or_zero(F.sum(F.col(m) * F.col("support")), total).alias(f"weighted_{m}") for m in measures],
        _or_zero(F.sum("hits"), total).alias("accuracy"),
        total.alias("support"),
        F.grouping("class").alias("is_total"),
    )

    def line(name: Column, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            name.alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            F.col("support"),
        )

    none = F.lit(None).cast("double")
    macro = line(F.lit("macro avg"), *[F.col(f"macro_{m}") for m in measures])
    weighted = line(F.lit("weighted avg"), *[F.col(f"weighted_{m}") for m in measures])
    accuracy = line(F.lit("accuracy"), none, none, F.col("accuracy"))
    # The macro mean of a single class is the value of that class.
    single = line(F.col("class").cast("string"), *[F.col(f"macro_{m}") for m in measures])
    lines = F.when(F.col("is_total") == 1, F.array(accuracy, macro, weighted)).otherwise(F.array(single))
    return summary.select(F.inline(lines))


def weighted_f1(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row ``f1`` (for each value of ``by``): mean of the class F1 scores, weighted by
    support."""
    classes = class_metrics(predictions, by)
    return classes.groupBy(*by).agg(_or_zero(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1"))


def confusion_matrix(predictions: DataFrame, labels: Sequence[int] = LABELS) -> DataFrame:
    """Cells ``(label, prediction, n, share)`` for all pairs of ``labels``, with
    ``share`` relative to the label; one aggregation with one count per cell."""

    def cell(a: int, b: int) -> str:
        return f"n_{a}_{b}"

    counts = predictions.agg(
        *[
            count_where((F.col("label") == a) & (F.col("prediction") == b)).alias(cell(a, b))
            for a in labels
            for b in labels
        ]
    )
    rows = []
    for a in labels:
        row_total = sum((F.col(cell(a, b)) for b in labels), F.lit(0))
        for b in labels:
            n = F.col(cell(a, b))
            rows.append(
                F.struct(
                    F.lit(a).alias("label"),
                    F.lit(b).alias("prediction"),
                    n.alias("n"),
                    _or_zero(n, row_total).alias("share"),
                )
            )
    return counts.select(F.inline(F.array(*rows)))


def best_model(scores: DataFrame, priority: Sequence[str] = CLASSIFIER_PRIORITY) -> DataFrame:
    """The one row ``(classifier, f1)`` with the highest score; on equal scores the
    classifier that comes first in ``priority``."""
    place = F.array_position(F.array(*[F.lit(c) for c in priority]), F.col("classifier"))
    ranked = scores.where(place > 0).orderBy(F.desc("f1"), place)
    return ranked.limit(1).select("classifier", "f1")


def coefficient_table(spark: SparkSession, names: Sequence[str], coefficients: Sequence[float]) -> DataFrame:
    """Model coefficients with the feature each belongs to (one row per feature)."""
    if len(names) != len(coefficients):
        raise ValueError(f"{len(names)} names for {len(coefficients)} coefficients")
    rows = [(n, float(c)) for n, c in zip(names, coefficients)]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def unscaled_coefficients(coefficients: DataFrame, peaks: Sequence[float]) -> DataFrame:
    """Coefficients for features as they were before max-abs scaling: ``position`` in the
    vector, ``feature``, ``coefficient`` (scaled) and ``unscaled``. ``peaks`` are the
    scaler's maxima, in the order of the vector; a feature that is always 0 has none."""
    spark = coefficients.sparkSession
    named = [(i, r["feature"], r["coefficient"]) for i, r in enumerate(coefficients.collect())]
    rows = [(i, name, c, c / peak if peak else 0.0) for (i, name, c), peak in zip(named, peaks, strict=True)]
    return spark.createDataFrame(rows, "position int, feature string, coefficient double, unscaled double")


def linear_margins(rows: DataFrame, table: DataFrame, intercept: float, key: str) -> DataFrame:
    """``key`` and ``margin`` of a linear model on unscaled ``features``: each element meets
    its coefficient by position, and the products are summed (one row of ``table`` a
    feature, so it is broadcast)."""
    long = rows.select(key, F.posexplode(vector_to_array("features")).alias("position", "value"))
    met = long.join(F.broadcast(table.select("position", "unscaled")), "position")
    return met.groupBy(key).agg((F.sum(F.col("value") * F.col("unscaled")) + intercept).alias("margin"))


def rank_coefficients(coefficients: DataFrame, by_size: bool = False) -> DataFrame:
    """Highest coefficient first; with ``by_size`` the highest absolute value."""
    if by_size:
        coefficients = coefficients.withColumn("coefficient", F.abs("coefficient"))
    return coefficients.orderBy(F.desc("coefficient"), F.asc("feature"))
