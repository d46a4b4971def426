"""The contexts of a suffix tree, from its grams in one sorted pass.

Sorted by their contexts, the nearest symbol first, the grams of a context of any size stand
side by side, and those of its suffix (the context without its farthest symbol) around them.
So a task with a range of the sorted grams counts and tests nearly all contexts in it alone.
Only a context that the range begins or ends in may go on in another range: for each range
one at either end for each size. Their counts, and those of the contexts that are tested
against them, are put together and tested in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.operators.materialise import materialise

TREE, EDGE, KEPT = 0, 1, 2  # a gram of the tree; a gram to be put together; a context that stays
_SLICE = 1 << 20


def divergent_contexts(levels: list[DataFrame], divergence: float, bits: int) -> DataFrame:
    """``size``, ``context`` of the tree: all contexts whose distribution saves at least
    ``divergence`` nats per next symbol against their suffix's, and their suffixes.

    ``levels``: ``key``, ``n`` of the grams with contexts of 0, 1, ... symbols."""
    found = None
    for size in range(1, len(levels)):
        mask = (1 << bits * size) - 1
        above = levels[size - 1].select(F.col("key").alias("short"), F.col("n").alias("n_short"))
        above_totals = levels[size - 1].groupBy(F.shiftright("key", bits).alias("short_context")).agg(
            F.sum("n").alias("total_short")
        )
        rows = levels[size].select(
            "n", F.shiftright("key", bits).alias("context"), F.col("key").bitwiseAND(F.lit(mask)).alias("short")
        )
        # The totals of a context are constant in it, so they come in after its rows are summed.
        sums = rows.join(above, "short").groupBy("context").agg(
            F.sum(F.col("n") * F.log(F.col("n") / F.col("n_short"))).alias("saved"),
            F.sum("n").alias("total"),
            F.count(F.lit(1)).alias("types"),
        )
        sums = sums.withColumn("short_context", F.col("context").bitwiseAND(F.lit(mask >> bits)))
        gains = sums.join(above_totals, "short_context").withColumn(
            "gain", F.col("saved") + F.col("total") * F.log(F.col("total_short") / F.col("total"))
        )
        gains = gains.where(F.col("gain") >= divergence * F.col("types"))
        gains = gains.select(F.lit(size).alias("size"), "context")
        found = gains if found is None else found.unionByName(gains)
    sizes = F.explode(F.sequence(F.lit(1), F.col("size"))).alias("kept")
    shorter = found.select(sizes, "context").select(
        F.col("kept").alias("size"),
        F.expr(f"context & (shiftleft(1L, {bits} * kept) - 1)").alias("context"),
    )
    return shorter.distinct()


def _nearest_first(key: Column, depth: int, bits: int) -> Column:
    """A gram's key with its context turned round: the nearest symbol in the highest bits."""
    symbol = F.lit((1 << bits) - 1).cast("long")
    parts = [key.bitwiseAND(symbol)]
    for back in range(1, depth + 1):
        own = F.shiftright(key, bits * back).bitwiseAND(symbol)
        parts.append(F.shiftleft(own, bits * (depth + 1 - back)))
    return reduce(Column.bitwiseOR, parts)


def _turned(contexts: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Contexts with their symbols in the opposite order."""
    out = np.zeros_like(contexts)
    for place in range(size):
        out = out << bits | contexts >> bits * place & (1 << bits) - 1
    return out


def _suffix(keys: np.ndarray, bits: int) -> np.ndarray:
    """The gram without the farthest symbol of its context (nearest symbol highest)."""
    return keys >> 2 * bits << bits | keys & (1 << bits) - 1


def _runs(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of sorted grams, where each begins, and how many grams it has."""
    own = keys >> bits
    heads = np.flatnonzero(np.diff(own, prepend=-1))
    return own[heads], heads, np.diff(np.append(heads, len(keys)))


def scan_range(
    keys: np.ndarray, counts: np.ndarray, depth: int, bits: int, divergence: float
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``state``, ``size``, keys and counts found in one range of the sorted grams; the keys
    are those of `divergent_contexts` again (of a ``KEPT`` row: the context alone)."""
    levels = [(keys, counts)]
    for _ in range(depth):
        shorter = _suffix(levels[0][0], bits)
        order = np.argsort(shorter, kind="stable")
        shorter = shorter[order]
        heads = np.flatnonzero(np.diff(shorter, prepend=-1))
        levels.insert(0, (shorter[heads], np.add.reduceat(levels[0][1][order], heads)))
    ends = keys[[0, -1]] >> bits
    kept_above = np.zeros(0, np.int64)
    for size in range(depth, -1, -1):
        keys, counts = levels.pop()
        contexts, heads, types = _runs(keys, bits)
        if size:
            # Not to be tested here: the counts of its suffix are not all in this range.
            edge = np.isin(contexts >> bits, ends >> bits * (depth - size + 1))
            short_keys, short_counts = levels[-1]
            short_contexts, short_heads, _ = _runs(short_keys, bits)
            total = np.add.reduceat(counts, heads)
            total_short = np.add.reduceat(short_counts, short_heads)[np.searchsorted(short_contexts, contexts >> bits)]
            n_short = short_counts[np.searchsorted(short_keys, _suffix(keys, bits))]
            saved = np.add.reduceat(counts * np.log(counts / n_short), heads)
            kept = ~edge & (saved + total * np.log(total_short / total) >= divergence * types)
        else:
            edge, kept = np.ones(1, bool), np.zeros(1, bool)
        kept |= np.isin(contexts, kept_above >> bits)
        kept_above = contexts[kept]
        out = _turned(keys >> bits, size, bits) << bits | keys & (1 << bits) - 1
        for state, wanted in ((TREE, kept & ~edge), (EDGE, edge)):
            own = np.repeat(wanted, types)
            yield state, size, out[own], counts[own]
        stays = _turned(contexts[kept & edge], size, bits)
        yield KEPT, size, stays, np.zeros_like(stays)


def scan_grams(grams: DataFrame, depth: int, bits: int, divergence: float) -> DataFrame:
    """``state``, ``size``, ``key``, ``n`` of `scan_range` over all ranges of the sorted grams
    (``key``, ``n``, each key once, contexts of ``depth`` symbols)."""
    names, kinds = ["state", "size", "key", "n"], [pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        keys, counts = (np.concatenate(part) for part in zip(*parts))
        for state, size, found, n in scan_range(keys, counts, depth, bits, divergence):
            for at in range(0, len(found), _SLICE):
                own = found[at : at + _SLICE], n[at : at + _SLICE]
                same = [np.full(len(own[0]), value, np.int32) for value in (state, size)]
                columns = [pa.array(c, kind) for c, kind in zip([*same, *own], kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    turned = grams.select(_nearest_first(F.col("key"), depth, bits).alias("turned"), "n")
    return turned.orderBy("turned").mapInArrow(scan, "state int, size int, key bigint, n bigint")


def context_tree(grams: DataFrame, depth: int, divergence: float, bits: int) -> DataFrame:
    """``size``, ``key``, ``n``: the grams of the empty context and of all contexts of up to
    ``depth`` symbols that the tree has (see `divergent_contexts`). ``grams`` are written."""
    scanned = materialise(scan_grams(grams, depth, bits, divergence))
    edge = scanned.where(F.col("state") == EDGE).groupBy("size", "key").agg(F.sum("n").alias("n"))
    edge = materialise(edge)
    levels = [edge.where(F.col("size") == size).select("key", "n") for size in range(depth + 1)]
    stays = scanned.where(F.col("state") == KEPT).select("size", F.col("key").alias("context"))
    kept = divergent_contexts(levels, divergence, bits).unionByName(stays).where(F.col("size") > 0).distinct()
    keyed = edge.withColumn("context", F.shiftright("key", bits))
    own = keyed.join(materialise(kept), ["size", "context"], "left_semi")
    parts = [scanned.where(F.col("state") == TREE), own, edge.where(F.col("size") == 0)]
    return reduce(DataFrame.unionByName, [part.select("size", "key", "n") for part in parts])
