"""Whether a trained classifier is what it should be: checks that need no second trainer.

Each is one pass over the rows: sums of vectors that are combined in the tasks, never a
row on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.constants import SEED

FEATURES = "scaled_features"


def _weight(rows: DataFrame, weights: str | None) -> Column:
    return F.lit(1.0) if weights is None else F.col(weights)


def log_loss_gradient(rows: DataFrame, probability: Column, weights: str | None = None) -> np.ndarray:
    """Gradient of the mean weighted log loss at a logistic model's coefficients and, last,
    its intercept; ``probability`` is what the model gives label 1.

    It is the mean of (p - label) times the features: the sum over label 0, where p - label
    is p, less the sum over label 1, where label - p is 1 - p. Both come from one
    aggregation of vectors.
    """
    label = F.col("label")
    size = F.when(label == 0, probability).otherwise(1.0 - probability) * _weight(rows, weights)
    parts = rows.select(label.alias("label"), FEATURES, size.alias("size"), _weight(rows, weights).alias("w"))
    sums = parts.groupBy("label").agg(
        Summarizer.metrics("sum").summary(F.col(FEATURES), F.col("size")).alias("sums"),
        F.sum("size").alias("size"), F.sum("w").alias("w"),
    )
    found = {r["label"]: r for r in sums.select("label", "sums.sum", "size", "w").collect()}
    total = sum(r["w"] for r in found.values())
    signed = [(1 if k == 0 else -1) * np.append(r["sum"].toArray(), r["size"]) for k, r in found.items()]
    return np.sum(signed, axis=0) / total


def settled_logistic(rows: DataFrame, model, weights: str | None = None) -> float:
    """Length of the gradient at the model, relative to that at the zero model: 0 at the
    optimum of the unregularised loss."""
    probability = vector_to_array("probability")[1]
    there = log_loss_gradient(model.transform(rows.select("label", FEATURES, *([weights] if weights else []))), probability, weights)
    start = log_loss_gradient(rows, F.lit(0.5), weights)
    return float(np.linalg.norm(there) / max(np.linalg.norm(start), 1e-300))


def hinge_objectives(rows: DataFrame, models: np.ndarray, weights: str | None = None) -> np.ndarray:
    """Mean weighted hinge loss of each of some linear models, a row of coefficients and
    the intercept each. One pass: a task multiplies its batches with all models and sends
    on one row of sums a batch."""
    wide = rows.select(
        vector_to_array(FEATURES).alias("x"),
        F.when(F.col("label") == 1, 1.0).otherwise(-1.0).alias("y"),
        _weight(rows, weights).cast("double").alias("w"),
    )
    count = len(models)

    def losses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch) == 0:
                continue
            margins = np.stack(batch["x"].to_numpy()) @ models[:, :-1].T + models[:, -1]
            loss = np.maximum(0.0, 1.0 - batch["y"].to_numpy()[:, None] * margins)
            w = batch["w"].to_numpy()
            yield pd.DataFrame({"model": np.arange(count), "loss": loss.T @ w, "w": np.full(count, w.sum())})

    sums = wide.mapInPandas(losses, "model int, loss double, w double")
    totals = sums.groupBy("model").agg((F.sum("loss") / F.sum("w")).alias("loss")).collect()
    return np.array([r["loss"] for r in sorted(totals, key=lambda r: r["model"])])


def settled_svm(
    rows: DataFrame, model, weights: str | None = None, *, directions: int = 32, step: float = 0.05, seed: int = SEED
) -> tuple[float, float]:
    """Hinge objective of the model, and the most that a step away from it lowers it (0
    or less: none does).

    Steps go ``step`` of the model's length along random directions, both ways, and
    towards and away from the zero model. The objective is convex, so a model that is not
    optimal has such steps; they are sampled, so this shows faults and proves nothing.
    """
    here = np.append(model.coefficients.toArray(), model.intercept)
    draws = np.random.default_rng(seed).normal(size=(directions, len(here)))
    draws /= np.linalg.norm(draws, axis=1, keepdims=True)
    length = max(np.linalg.norm(here), 1.0) * step
    steps = np.concatenate([draws * length, -draws * length, [here * step], [-here * step]])
    losses = hinge_objectives(rows, np.concatenate([[here], here + steps]), weights)
    return float(losses[0]), float(losses[0] - losses[1:].min())
