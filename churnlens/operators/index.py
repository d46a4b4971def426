"""Dense numeric ids for strings, by falling frequency."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.lookup import BROADCAST_BYTES, lookup, measure
from churnlens.operators.materialise import materialise

OCCURRENCES = "occurrences"
_SLOT_BITS = 33


def frequency_index(
    rows: DataFrame,
    column: str,
    output: str,
    *,
    extra: dict[str, Column] | None = None,
    path: str | None = None,
) -> DataFrame:
    """One row per distinct value: value, id (double), ``occurrences``.

    Ids count up from 0.0 by falling frequency, equal frequencies by value. The
    values are range-sorted and numbered inside each partition; the only thing
    shared between partitions is how many values each one holds, so no list of
    values ever reaches the driver or a single task. ``extra`` aggregates are
    computed along with the counts.
    """
    counts = rows.where(F.col(column).isNotNull()).groupBy(column)
    counts = counts.agg(F.count(F.lit(1)).alias(OCCURRENCES), *[c.alias(n) for n, c in (extra or {}).items()])
    ordered = counts.orderBy(F.desc(OCCURRENCES), F.asc(column))
    # Partition boundaries may differ when a sort is run again, so the numbering
    # is written down before it is read twice.
    slots = materialise(ordered.withColumn("slot", F.monotonically_increasing_id()), path)

    part = F.shiftright("slot", _SLOT_BITS)
    place = F.col("slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    slots = slots.withColumns({"part": part, "place": place})
    # One row per sort partition: as small as the shuffle partition setting.
    sizes = slots.groupBy("part").agg(F.count(F.lit(1)).alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    numbered = slots.join(F.broadcast(starts), "part")
    return numbered.select(
        column,
        (F.col("start") + F.col("place")).cast("double").alias(output),
        OCCURRENCES,
        *(extra or {}),
    )


def attach_index(
    rows: DataFrame,
    index: DataFrame,
    column: str,
    output: str,
    *,
    invalid: str = "error",
    broadcast_bytes: int = BROADCAST_BYTES,
    measured: tuple[int, int] | None = None,
) -> DataFrame:
    """Add the id column ``output`` (and the index's extra columns) to ``rows``.

    A null or unknown value raises (``error``), drops the row (``skip``) or gets
    the first unused id (``keep``). ``measured`` is what ``measure`` says about the
    index, when the caller has asked already.
    """
    if invalid not in ("error", "skip", "keep"):
        raise ValueError(f"unknown way to treat invalid values: {invalid!r}")
    values, size = measured or measure(index)
    found = lookup(
        rows,
        index,
        column,
        how="inner" if invalid == "skip" else "left",
        weight=OCCURRENCES,
        broadcast_bytes=broadcast_bytes,
        size=size,
    )
    if invalid == "keep":
        return found.withColumn(output, F.coalesce(output, F.lit(float(values))))
    if invalid == "error":
        message = F.concat(F.lit(f"no index for {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
        return found.withColumn(output, F.coalesce(output, F.raise_error(message).cast("double")))
    return found


def encode_category(rows: DataFrame, column: str, output: str, *, invalid: str = "error") -> DataFrame:
    """Id ``<column>Index`` and one-hot vector ``output`` of a column with few
    values (plan, gender); the rarest value is the all-zero vector."""
    indexed = f"{column}Index"
    stages = [
        StringIndexer(inputCol=column, outputCol=indexed, handleInvalid=invalid),
        OneHotEncoder(inputCols=[indexed], outputCols=[output], dropLast=True),
    ]
    return Pipeline(stages=stages).fit(rows).transform(rows)
