"""Attach a one-row-per-key table to a large table, whatever the key skew.

``rows`` may be a whole event log in which one key holds a third of all rows.
The table is measured first: small, it is broadcast and ``rows`` never moves.
Otherwise both sides are shuffled once, on the key and a salt. A key that holds
more than one partition's share of the rows is spread over as many salts as its
share asks for, so no partition gets much more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.operators.materialise import materialise

BROADCAST_BYTES = 128 * 1024 * 1024
_ROW_OVERHEAD = 32
_SALT, _SALTS = "__salt", "__salts"


def measure(table: DataFrame) -> tuple[int, int]:
    """Rows and estimated in-memory bytes of a materialised table, in one job."""
    fixed = _ROW_OVERHEAD + 8 * len(table.columns)
    size = F.lit(0).cast("long")
    for field in table.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            size = size + 8 * F.coalesce(F.size(field.name), F.lit(0))
    rows, extra = table.agg(F.count(F.lit(1)), F.sum(size)).first()
    return rows, rows * fixed + (extra or 0)


def heavy_keys(rows: DataFrame, table: DataFrame, key: str, weight: str | None, partitions: int) -> DataFrame:
    """Keys with more than one partition's share of the rows, and the salts each needs.

    The shares add up to one, so there are fewer such keys than partitions and the
    result can be broadcast, however many keys and rows there are.
    """
    if weight is not None:
        counts = table.select(key, F.col(weight).alias("n"))
    else:
        counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        counts = materialise(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    salts = F.ceil(F.col("n") * partitions / F.lit(max(total, 1))).cast("int")
    return counts.where(F.col("n") * partitions > total).select(key, salts.alias(_SALTS))


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    *,
    how: str = "left",
    weight: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Join ``table`` (unique on ``key``, materialised) to every row of ``rows``.

    ``how`` is ``left`` or ``inner``. ``weight`` names a column of ``table`` that
    says how many of the ``rows`` each key has, if that was counted with it; it is
    used to find the heavy keys and is not part of the result. Without it the keys
    of ``rows`` are counted. ``size`` is the measured size of ``table`` in bytes,
    when the caller has it already. The salt of a row comes from its values, so a
    task that runs again sends it to the same place; a null key matches nothing
    and its rows are spread over all partitions.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    wanted = [c for c in table.columns if c != weight]
    if size is None:
        size = measure(table)[1]
    if size <= broadcast_bytes:
        return rows.join(F.broadcast(table.select(wanted)), key, how)

    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(rows, table, key, weight, partitions)
    hashable = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = F.when(F.col(key).isNull(), F.lit(partitions)).otherwise(F.coalesce(F.col(_SALTS), F.lit(1)))
    salted = rows.join(F.broadcast(heavy), key, "left")
    salted = salted.withColumn(_SALT, F.pmod(F.xxhash64(*hashable), spread).cast("int")).drop(_SALTS)
    copies = table.select(wanted).join(F.broadcast(heavy), key, "left")
    salts = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)
    copies = copies.withColumn(_SALT, F.explode(salts)).drop(_SALTS)
    return salted.join(copies, [key, _SALT], how).drop(_SALT)
