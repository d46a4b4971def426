"""Benchmark passages in documents, in DataFrame operations only.

For each benchmark item a document is looked at in windows of as many words as the
item has. Windows and items get a SimHash of their word shingles; fingerprints are
cut into one block more than bits may differ, so any two within the radius agree in
a block, and a join on blocks finds them all. The weighted similarity of the
shingles then decides.

A window that shares no shingle with an item of its size cannot be similar to one.
So windows are only opened where enough shingles of items of that size stand, which
loses nothing and leaves most documents at a join of shingle hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.operators.lookup import BROADCAST_BYTES, lookup, measure
from churnlens.operators.materialise import materialise

WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
_NOT_A_WORD = r"[^\p{L}\p{N}\p{M}]+"


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters, digits and marks; none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _NOT_A_WORD), lambda w: w != "")


def with_shingles(table: DataFrame, text_col: str, words: int, name: str = "shingles") -> DataFrame:
    """Add the hashes of all word shingles in order, repeats included.

    The hashed words are bound to a lambda variable: as a column of their own they
    would be put into the inner lambda when a filter is pushed down, and worked out
    again for every shingle.
    """
    hashed = F.transform(words_of(F.col(text_col)), lambda w: F.xxhash64(w))

    def shingled(h: Column) -> Column:
        last = F.size(h) - words
        at = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)])
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), at)).otherwise(F.array().cast("array<bigint>"))

    return table.withColumn(name, F.get(F.transform(F.array(hashed), shingled), 0))


def simhash(shingles: str) -> Column:
    """64 bits, each set when over half of the shingle hashes have it."""
    return F.expr(
        f"aggregate(sequence(0, 63), 0L, (print, bit) -> print | shiftleft(CAST("
        f"2 * aggregate({shingles}, 0, (ones, h) -> ones + CAST(shiftright(h, bit) & 1L AS INT)) > size({shingles})"
        f" AS BIGINT), bit))"
    )


def blocks(fp: str, radius: int) -> Column:
    """The fingerprint's ``radius + 1`` blocks as an array of (number, value)."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    parts = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        mask = F.lit((1 << (high - low)) - 1 if high - low < 64 else -1).cast("long")
        value = F.shiftrightunsigned(fp, low).bitwiseAND(mask)
        parts.append(F.struct(F.lit(i).alias("number"), value.alias("value")))
    return F.array(*parts)


def common_weight(one: str, two: str) -> Column:
    """How many shingles two arrays have in common, each as often as both have it."""
    weighted = F.expr(
        f"aggregate(array_distinct({one}), 0, (sum, x) -> sum + least("
        f"size(filter({one}, y -> y = x)), size(filter({two}, y -> y = x))))"
    )
    plain = (F.size(F.array_distinct(one)) == F.size(one)) | (F.size(F.array_distinct(two)) == F.size(two))
    return F.when(plain, F.size(F.array_intersect(one, two))).otherwise(weighted)


def _sized(table: DataFrame, limit: int) -> DataFrame:
    """Broadcast what was written and measured small enough; leave the rest to Spark."""
    return F.broadcast(table) if measure(table)[1] <= limit else table


def benchmark_matches(
    docs: DataFrame,
    items: DataFrame,
    *,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Documents that hold a benchmark item: ``id_col``, ``item_col``, ``start_word``,
    ``n_words`` of the item, ``similarity`` of the most similar window (the first of several).

    Words are lower-cased runs of letters and digits, so case, punctuation and white space
    don't matter. Similarity is that of the multisets of ``words``-word shingles (common
    weight over joint weight). A document shorter than an item is one window. An item of
    fewer words than a shingle says too little and matches nothing, like a null or empty
    one; so does a document without a shingle or without an id. Rows that repeat an id are
    looked at each and count as one document; items that repeat give one row for each id.
    At a similarity of 0.8 a 64-bit SimHash differs in ten bits on average; the default
    radius is three and a half deviations above.
    """
    items = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("__text"))
    items = with_shingles(items, "__text", words, "of_item").where(F.size("of_item") > 0)
    items = items.select("item", "of_item", F.size("of_item").alias("m"))
    items = materialise(items.withColumn("fp_item", simhash("of_item")))

    # Which window sizes each shingle may stand in.
    standing = items.select(F.explode("of_item").alias("shingle"), "m").groupBy("shingle")
    standing = materialise(standing.agg(F.collect_set("m").alias("sizes")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text")).where(F.col(id_col).isNotNull())
    # The outer form: Spark would filter on the array's size first, and work it out twice.
    placed = with_shingles(texts, "__text", words).select("id", F.posexplode_outer("shingles").alias("at", "shingle"))
    hits = lookup(placed, standing, "shingle", how="inner", broadcast_bytes=broadcast_bytes)
    hits = hits.select("id", "at", F.explode("sizes").alias("m"))

    # A similar window has at least `need` of them within its m places.
    spots = hits.groupBy("id", "m").agg(F.array_sort(F.collect_set("at")).alias("at"))
    spots = spots.withColumn("need", F.ceil(F.col("m") * similarity - 1e-9).cast("int"))
    starts = F.expr(
        "array_distinct(flatten(transform("
        "filter(sequence(0, size(at) - need), i -> at[i + need - 1] - at[i] < m),"
        "i -> sequence(greatest(0, at[i + need - 1] - m + 1), at[i]))))"
    )
    spots = spots.where("size(at) >= need").withColumn("starts", starts).where("size(starts) > 0")
    spots = spots.groupBy("id").agg(F.collect_list(F.struct("m", "starts")).alias("spots"))

    spotted = _sized(materialise(spots), broadcast_bytes)
    opened = with_shingles(texts.join(spotted, "id"), "__text", words)
    opened = opened.select("id", "shingles", F.explode_outer("spots").alias("spot"))
    opened = opened.select("id", "shingles", F.col("spot.m").alias("m"), F.explode_outer("spot.starts").alias("start"))
    # A window that would reach beyond the end is only of use in a document shorter than it.
    fits = (F.col("start") + F.col("m") <= F.size("shingles")) | (F.col("start") == 0)
    windows = opened.where(fits).select("id", "m", "start", F.expr("slice(shingles, start + 1, m)").alias("window"))
    windows = materialise(windows.withColumn("fp", simhash("window")))

    keys = windows.select("id", "m", "start", "fp", F.explode(blocks("fp", radius)).alias("block"))
    item_keys = items.select("item", "m", "fp_item", F.explode(blocks("fp_item", radius)).alias("block"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp_item"))) <= radius
    found = keys.join(_sized(materialise(item_keys), broadcast_bytes), ["m", "block"]).where(near)
    found = found.select("id", "m", "start", "item").distinct()

    checked = found.join(windows.select("id", "m", "start", "window").distinct(), ["id", "m", "start"])
    checked = checked.join(_sized(items.select("item", "of_item"), broadcast_bytes), "item")
    common = common_weight("window", "of_item")
    checked = checked.withColumn("common", common)
    joint = F.size("window") + F.size("of_item") - F.col("common")
    checked = checked.withColumn("similarity", F.col("common") / joint).where(F.col("similarity") >= similarity)
    best = checked.groupBy("id", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"), "m")).alias("best")
    )
    return best.select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), (-F.col("best.back")).alias("start_word"),
        (F.col("best.m") + words - 1).alias("n_words"), F.col("best.similarity").alias("similarity"),
    )
