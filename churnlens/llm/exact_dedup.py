"""Exact duplicates by two-pass Bloom filtering.

Pass one sets the bits of every row's hash and notes which bits two rows have set.
A row all of whose bits were set twice is possibly repeated; every other row has no
copy for certain. Pass two sends only the possible ones through a shuffle, where
their full SHA-256 decides.

The filter is sized by the number of rows and bounded by ``max_bits``. Beyond that
bound it fills up: more rows are called possible and shuffle, and the result is the
same.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.tables import map_batches
from churnlens.operators.lookup import lookup
from churnlens.operators.materialise import materialise

BITS_PER_ROW = 16
PROBES = 2
MAX_BITS = 1 << 30
_SEGMENT = 15  # log2 of the bits that bitmap_construct_agg packs into one value


def digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``text_sha256`` of the text with A-Z lower-cased (null: empty), ``hash``."""

    def digest(batches):
        for batch in batches:
            found = [hashlib.sha256((t or b"").lower()).digest() for t in batch["text"]]
            yield {
                id_col: batch[id_col],
                "text_sha256": [d.hex() for d in found],
                "hash": [int.from_bytes(d[:8], "little", signed=True) for d in found],
            }

    table = docs.select(id_col, F.col(text_col).alias("text"))
    kinds = {id_col: dict(docs.dtypes)[id_col], "text": "binary"}
    return map_batches(table, kinds, digest, f"`{id_col}` {kinds[id_col]}, text_sha256 string, hash bigint")


def filter_bits(rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS) -> int:
    """The power of two that gives each row its bits, within the bound."""
    return min(max_bits, max(1 << _SEGMENT, 1 << max(0, rows * bits_per_row - 1).bit_length()))


def positions(bits: int, probes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col("hash"), F.lit(i)), F.lit(bits)) for i in range(probes)]


def repeated_bits(hashes: DataFrame, bits: int, probes: int) -> np.ndarray:
    """Bit array of the positions that more than one row has set.

    Counts are combined before the shuffle, so a copied text costs one row per task.
    The driver gets at most ``bits / 8`` bytes, in segments.
    """
    # The positions of one row are made distinct: they must not repeat each other.
    places = F.array_distinct(F.array(*positions(bits, probes)))
    counts = hashes.select(F.explode(places).alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    twice = counts.where("n > 1").select(
        F.shiftright("place", _SEGMENT).alias("segment"), F.col("place").bitwiseAND((1 << _SEGMENT) - 1).alias("bit")
    )
    packed = twice.groupBy("segment").agg(F.bitmap_construct_agg(F.col("bit")).alias("bitmap"))
    found = np.zeros(bits // 8, np.uint8)
    size = (1 << _SEGMENT) // 8
    for segment, bitmap in packed.toLocalIterator():
        found[segment * size : (segment + 1) * size] = np.frombuffer(bitmap, np.uint8)
    return found


def possibly_repeated(hashes: DataFrame, bits: int, probes: int) -> DataFrame:
    """Add ``possible``: whether all bits of the row were set by another row too."""
    shared = hashes.sparkSession.sparkContext.broadcast(repeated_bits(hashes, bits, probes))

    @F.pandas_udf("boolean")
    def possible(*places: pd.Series) -> pd.Series:
        found = shared.value
        hit = np.ones(len(places[0]), bool)
        for column in places:
            place = column.to_numpy()
            hit &= (found[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
        return pd.Series(hit)

    return hashes.withColumn("possible", possible(*positions(bits, probes)))


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = BITS_PER_ROW,
    probes: int = PROBES,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so
    null and empty texts form one group. The largest id of a group stays. Rows that
    repeat an id count in ``group_size`` and share its decision. A null id never
    stays beside another id; a group with null ids only keeps its rows and has a null
    ``keep_id``. Other columns are not looked at; an empty table gives an empty result.
    """
    hashes = materialise(digests(docs, id_col=id_col, text_col=text_col))
    bits = filter_bits(hashes.count(), bits_per_row, max_bits)
    tagged = possibly_repeated(hashes, bits, probes)

    columns = [id_col, "keep_id", "group_size", "kept", "text_sha256"]
    single = tagged.where(~F.col("possible")).select(
        id_col, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    again = materialise(tagged.where("possible").select(id_col, "text_sha256"))
    groups = again.groupBy("text_sha256").agg(
        F.max(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.count(F.lit(1)).alias("weight")
    )
    decided = lookup(again, materialise(groups), "text_sha256", weight="weight")
    decided = decided.withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))
    return single.unionByName(decided.select(columns))
