"""Shards by vector bin packing over bytes, tokens and rows.

Equal texts form a group. Groups are dealt by hash into a fixed number of bundles;
groups with more than a bundle's share of the bytes or rows stand alone. How many
such groups there can be follows from their share, so the table of what is to be
placed is small for any input. Largest first, each is placed where the dot product
of its vector with the residual capacity is highest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.tables import small_batches
from churnlens.operators.materialise import materialise

OVERHEAD = 16
GRAIN = 256  # bundles for each shard
WHOLE = 4  # a group of more than 1/4 of a shard is split
_UNIT = ["alone", "high", "low", "piece"]


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each row of ``vectors`` (one row per item, one column per resource)."""
    total = vectors.sum(axis=0)
    need = vectors / np.where(total > 0, total, 1) * shards
    residual = np.ones((shards, vectors.shape[1]))
    place = np.zeros(len(vectors), int)
    for item in np.argsort(-need.max(axis=1), kind="stable"):
        place[item] = int(np.argmax(residual @ need[item]))
        residual[place[item]] -= need[item]
    return place


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Size, checksum, tokens and a 128-bit hash of each text; null counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.xxhash64(text).alias("high"),
        F.xxhash64(F.lit(1), text).alias("low"),
    )


def shard_documents(
    docs: DataFrame, *, shards: int = 40, grain: int = GRAIN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``size``, ``text_crc32``, ``tokens``, ``law``
    (``bytes``), ``shard``, ``slot`` (0, 1, ... within the shard), ``grown_shard`` (null).

    Equal texts go to one shard unless they hold more than a quarter of what a shard
    should; then they are dealt in pieces by id. A null text counts as empty, and null
    texts and empty ones are one group. Rows that repeat an id are placed each for itself;
    a null id is as good as any other. An empty table gives an empty result. Sizes differ
    by little more than the smallest things there are to place.
    """
    if shards < 1 or grain < WHOLE:
        raise ValueError("shards must be at least 1 and grain at least 4")
    spark = docs.sparkSession
    small_batches(spark)
    slim = materialise(describe(docs, id_col, text_col))
    total_size, total_rows = slim.agg(F.sum("size"), F.count(F.lit(1))).first()
    unit_size, unit_rows = (total_size or 0) / (shards * grain), total_rows / (shards * grain)

    # Each holds more than one share of bytes or of rows: at most 2 * shards * grain.
    groups = slim.groupBy("high", "low").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    large = groups.where((F.col("bytes") > unit_size) & (F.col("rows") > 1) | (F.col("rows") > max(unit_rows, 1)))
    shares = F.greatest(F.col("bytes") / max(unit_size, 1), F.col("rows") / max(unit_rows, 1))
    pieces = F.least(F.ceil(shares), F.col("rows")).cast("int")
    large = materialise(large.select("high", "low", pieces.alias("pieces")))

    alone = F.col("pieces").isNotNull()
    bundle = F.pmod(F.col("high"), F.lit(shards * grain))
    dealt = slim.join(F.broadcast(large), ["high", "low"], "left").select(
        id_col, "size", "text_crc32", "tokens", "pieces", alone.alias("alone"),
        F.when(alone, F.col("high")).otherwise(bundle).alias("high"),
        F.when(alone, F.col("low")).otherwise(F.lit(0)).alias("low"),
        F.when(alone, F.pmod(F.xxhash64(id_col), F.col("pieces"))).otherwise(F.lit(0)).alias("piece"),
    )
    units = dealt.groupBy(*_UNIT).agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"),
        F.max("pieces").alias("pieces"),
    )
    found = units.orderBy(*_UNIT).collect()  # a few for each shard and grain

    split = max(grain // WHOLE, 1)
    names: dict[tuple, int] = {}
    bundles = []
    for row in found:
        together = row["alone"] and row["pieces"] <= split
        name = (row["alone"], row["high"], row["low"], -1 if together else row["piece"])
        bundles.append(names.setdefault(name, len(names)))
    vectors = np.zeros((len(names), 3))
    for index, row in zip(bundles, found):
        vectors[index] += (row["bytes"], row["tokens"], row["rows"])
    places = pack(vectors, shards)
    held = [0] * shards
    table = []
    for index, row in zip(bundles, found):
        shard = int(places[index])
        table.append((*[row[c] for c in _UNIT], shard, held[shard]))
        held[shard] += row["rows"]
    schema = "alone boolean, high bigint, low bigint, piece bigint, shard int, start bigint"
    placed = spark.createDataFrame(table, schema)

    order = Window.partitionBy(*_UNIT).orderBy(id_col)
    numbered = dealt.drop("pieces").withColumn("__place", F.row_number().over(order))
    joined = numbered.join(F.broadcast(placed), _UNIT)
    return joined.select(
        id_col, "size", "text_crc32", "tokens", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("__place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
