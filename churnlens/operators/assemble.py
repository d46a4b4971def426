"""Joining feature tables, naming their columns, and vectors for training."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import MaxAbsScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_columns(table: DataFrame, prefix: str, key: str = "userId") -> DataFrame:
    """Every column but the key gets ``prefix_`` in front, in one projection."""
    return table.select(*[F.col(f"`{c}`").alias(c if c == key else f"{prefix}_{c}") for c in table.columns])


def whole_key(table: DataFrame, key: str) -> DataFrame:
    """The table with an id column as a whole number.

    Ids are doubles in stored tables. As join keys, Spark would first normalise
    doubles (NaN, -0.0) and so shuffle again what is partitioned already.
    """
    return table.withColumn(key, F.col(key).cast("long"))


def stored_key(table: DataFrame, key: str) -> DataFrame:
    """The table with an id column as stored, a double."""
    return table.withColumn(key, F.col(key).cast("double"))


def join_tables(tables: Sequence[DataFrame], key: str = "userId", how: str = "inner") -> DataFrame:
    """Join per-user tables on the user.

    Each of them is the result of an aggregation on the same key, so all are
    partitioned alike and the joins add no shuffle. With ``left`` every user of
    the first table stays and missing numbers become 0.
    """
    joined = reduce(lambda left, right: left.join(right, key, how), tables)
    return joined.na.fill(0) if how == "left" else joined


def assemble_features(table: DataFrame, key: str = "userId", label: str = "label") -> DataFrame:
    """``(key, features, label)`` with all other columns in one vector; their
    names are kept in the metadata of the vector column."""
    inputs = [c for c in table.columns if c not in (key, label)]
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(table)
    return vectors.select(key, "features", label)


def max_abs_scaler() -> MaxAbsScaler:
    return MaxAbsScaler(inputCol="features", outputCol="scaled_features")


def scale_columns(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Divide each column by its highest absolute value (0 if that is 0).

    The same as max-abs scaling of a vector, for plain columns. The maxima are
    one row, whatever the size of the table.
    """
    peaks = table.agg(*[F.max(F.abs(c)).alias(c) for c in columns]).first()
    scaled = {c: F.col(c) / F.lit(float(peaks[c])) if peaks[c] else F.lit(0.0) for c in columns}
    return table.withColumns(scaled)


def feature_names(table: DataFrame, column: str = "features") -> list[str]:
    """Names of the elements of a vector column, in order."""
    groups = table.schema[column].metadata["ml_attr"]["attrs"]
    attributes = sorted((a for group in groups.values() for a in group), key=lambda a: a["idx"])
    return [a["name"] for a in attributes]
