"""Rows in a global order: numbered without one task or the driver seeing them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.materialise import materialise

_SLOT_BITS = 33
PART, PLACE = "__part", "__place"


def ordered_slots(table: DataFrame, *order: str | Column, path: str | None = None) -> DataFrame:
    """``table`` sorted by ``order`` and written, with its sort partition and the row's
    place in it.

    Range bounds may differ when a sort is run again, so the numbers are written down
    with the rows and only read from then on. A key with many rows spans partitions if
    ``order`` goes on after it.
    """
    slotted = table.orderBy(*order).withColumn(PART, F.monotonically_increasing_id())
    place = F.col(PART).bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return materialise(slotted.withColumns({PLACE: place, PART: F.shiftright(PART, _SLOT_BITS)}), path)


def part_starts(slots: DataFrame) -> DataFrame:
    """``__part``, ``start``: how many rows stand in earlier partitions.

    One row for each sort partition: as many as the shuffle partition setting says.
    """
    sizes = slots.groupBy(PART).agg(F.count(F.lit(1)).alias("held"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(PART, F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))


def with_position(
    table: DataFrame, *order: str | Column, output: str = "position", path: str | None = None
) -> DataFrame:
    """``table`` with the long ``output``: 0 for the first row by ``order``, then 1, and so on.

    Only the size of each sort partition is shared. Rows that are equal in ``order``
    are numbered in any order.
    """
    slots = ordered_slots(table, *order, path=path)
    starts = part_starts(slots).withColumnRenamed("start", output)
    numbered = slots.join(F.broadcast(starts), PART)
    return numbered.select(*[F.col(f"`{c}`") for c in table.columns], (F.col(output) + F.col(PLACE)).alias(output))


def order_breaks(slots: DataFrame, *order: str | Column) -> DataFrame:
    """One row: ``rows`` of ``ordered_slots`` and ``breaks``, how many of them should not
    stand after the row before them.

    Neighbours are compared inside each sort partition, then the last row of a partition
    with the first of the next one: one row a partition.
    """
    key = F.struct(*order)
    inside = Window.partitionBy(PART).orderBy(PLACE)
    seen = slots.select(PART, PLACE, key.alias("key")).withColumn("above", F.lag("key").over(inside))
    wrong = F.coalesce((F.col("key") < F.col("above")).cast("long"), F.lit(0))
    parts = seen.groupBy(PART).agg(
        F.count(F.lit(1)).alias("held"), F.sum(wrong).alias("wrong"), F.min_by("key", PLACE).alias("first"),
        F.max_by("key", PLACE).alias("last"),
    )
    across = F.col("first") < F.lag("last").over(Window.orderBy(PART))
    edges = parts.select("held", (F.col("wrong") + F.coalesce(across.cast("long"), F.lit(0))).alias("wrong"))
    return edges.agg(
        F.coalesce(F.sum("held"), F.lit(0)).alias("rows"), F.coalesce(F.sum("wrong"), F.lit(0)).alias("breaks")
    )
