"""Implicit ratings, their factorisation, and latent user features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.constants import ALS_BLOCKS, ALS_RANK, ALS_REG, SEED
from churnlens.functions.scalars import count_where, share
from churnlens.operators.assemble import whole_key
from churnlens.operators.lookup import BROADCAST_BYTES, lookup
from churnlens.operators.slices import LAST_TS, is_recent
from churnlens.session import ensure_checkpoint_dir


def item_ratings(events: DataFrame, user: str = "userId", item: str = "artist") -> DataFrame:
    """Songs played per (user, item), relative to the user's most played item.

    NULL when none of the user's events has a song. The window runs over the
    aggregate, where a user has at most one row per item.
    """
    plays = events.where(F.col("artist").isNotNull()).groupBy(user, item).agg(F.count("song").alias("plays"))
    best = F.max("plays").over(Window.partitionBy(user))
    return plays.select(user, item, share(F.col("plays"), best).alias("rating"))


def period_ratings(events: DataFrame, user: str = "userId", item: str = "artist") -> DataFrame:
    """``rating`` over all events and ``recent_rating`` over the user's last week,
    for every pair of the whole log; 0 for a pair without songs in the last week.

    Both come from one aggregation over events with ``last_ts``: a pair that is
    absent from the last week and a pair without songs in it are both 0, so no
    join of two rating tables is needed.
    """
    if LAST_TS not in events.columns:
        raise ValueError("period_ratings needs events with last_ts")
    heard = events.where(F.col("artist").isNotNull())
    plays = heard.groupBy(user, item).agg(
        F.count("song").alias("plays"),
        count_where(F.col("song").isNotNull() & is_recent()).alias("recent_plays"),
    )
    mine = Window.partitionBy(user)
    recent = share(F.col("recent_plays"), F.max("recent_plays").over(mine))
    return plays.select(
        user,
        item,
        share(F.col("plays"), F.max("plays").over(mine)).alias("rating"),
        F.coalesce(recent, F.lit(0.0)).alias("recent_rating"),
    )


def carry_over(
    known: DataFrame, recent: DataFrame, user: str = "userId", item: str = "artist", rating: str = "rating"
) -> DataFrame:
    """Ratings of ``recent`` for every pair of ``known``, 0 where there is none.
    For two rating tables that exist already; see ``period_ratings`` otherwise."""
    found = known.select(user, item).join(recent.select(user, item, rating), [user, item], "left")
    return found.select(user, item, F.coalesce(rating, F.lit(0.0)).alias(rating))


def rated(ratings: DataFrame, rating: str = "rating") -> DataFrame:
    """Pairs that have a rating; the factorisation accepts no others."""
    return ratings.where(F.col(rating).isNotNull())


def factorise(
    ratings: DataFrame,
    user: str = "userIdIndex",
    item: str = "artistIndex",
    rating: str = "rating",
    *,
    rank: int = ALS_RANK,
    reg: float = ALS_REG,
    seed: int = SEED,
    user_blocks: int = ALS_BLOCKS,
    item_blocks: int = ALS_BLOCKS,
) -> tuple[DataFrame, DataFrame]:
    """User and item factors ``(id, features)`` of an explicit ALS fit; ids have to fit an int.

    Blocks are how the fit is spread out. Spark draws the first factors by user block,
    so the result depends on ``user_blocks``: they are parameters with fixed defaults
    and never follow the size of the data. A run on many ratings sets them so that
    a block's ratings fit a task.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    als = ALS(
        rank=rank,
        regParam=reg,
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        coldStartStrategy="drop",
        numUserBlocks=user_blocks,
        numItemBlocks=item_blocks,
        seed=seed,
    )
    model = als.fit(rated(ratings, rating))
    return model.userFactors, model.itemFactors


def item_factors(ratings: DataFrame, user: str = "userIdIndex", item: str = "artistIndex", **options) -> DataFrame:
    """The item factors of ``factorise``."""
    return factorise(ratings, user, item, **options)[1]


def normal_residuals(
    ratings: DataFrame,
    solved: DataFrame,
    fixed: DataFrame,
    solved_id: str,
    fixed_id: str,
    rating: str = "rating",
    *,
    reg: float = ALS_REG,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """How well each factor vector of ``solved`` fits the ``fixed`` ones: ``id``, ``rank``,
    ``finite``, ``ratings`` and ``residual``.

    A factor vector x is the least-squares answer to its ratings when it solves
    (sum f f' + reg n I) x = sum r f over the factors f of its n ratings r. ``residual`` is
    the length of the difference between both sides, relative to the right one (as it is,
    if all ratings are 0). With x known, the left side is sum (f.x) f + reg n x: two vectors of sums for each rating,
    combined before they are shuffled, and no matrix. ``solved`` has to be written already
    (it is read twice), ``fixed`` too.
    """
    pairs = whole_key(whole_key(rated(ratings, rating).select(solved_id, fixed_id, rating), solved_id), fixed_id)
    rank = len(fixed.first()["features"])
    mine = solved.select(F.col("id").cast("long").alias(solved_id), F.col("features").cast("array<double>").alias("x"))
    other = fixed.select(F.col("id").cast("long").alias(fixed_id), F.col("features").cast("array<double>").alias("f"))
    limit = {"how": "inner", "broadcast_bytes": broadcast_bytes}
    met = lookup(lookup(pairs, other, fixed_id, **limit), mine, solved_id, **limit)
    products = F.zip_with("f", "x", lambda a, b: a * b)
    met = met.withColumn("guess", F.aggregate(products, F.lit(0.0), lambda a, b: a + b))
    sums = met.groupBy(solved_id).agg(
        F.count(F.lit(1)).alias("ratings"),
        *[F.sum(F.col("guess") * F.col("f")[k]).alias(f"left_{k}") for k in range(rank)],
        *[F.sum(F.col(rating) * F.col("f")[k]).alias(f"right_{k}") for k in range(rank)],
    )
    found = sums.join(mine, solved_id)
    left = F.array(*[F.col(f"left_{k}") + reg * F.col("ratings") * F.col("x")[k] for k in range(rank)])
    right = F.array(*[F.col(f"right_{k}") for k in range(rank)])

    def length(vector: Column) -> Column:
        return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, b: a + b * b))

    gap = length(F.zip_with(left, right, lambda a, b: a - b))
    return found.select(
        F.col(solved_id).alias("id"),
        F.size("x").alias("rank"),
        F.forall("x", lambda v: ~F.isnan(v) & (F.abs(v) < float("inf"))).alias("finite"),
        "ratings",
        F.coalesce(F.try_divide(gap, length(right)), gap).alias("residual"),
    )


def latent_features(
    ratings: DataFrame,
    factors: DataFrame,
    outputs: dict[str, str],
    user: str = "userIdIndex",
    item: str = "artistIndex",
    *,
    rank: int = ALS_RANK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Product of the rating matrix and the factor matrix, one column per factor.

    ``outputs`` maps a column prefix to the rating column it is computed from, so
    several rating columns share one join: ``<prefix>_<k>`` is the sum over the
    user's items of rating times factor k. Neither matrix is ever local: ratings
    meet factors in a join, and the sums are combined before they are shuffled.
    """
    by_item = factors.select(F.col("id").cast("long").alias(item), F.col("features"))
    pairs = lookup(whole_key(ratings, item), by_item, item, how="inner", broadcast_bytes=broadcast_bytes)
    products = _products(outputs, rank)
    return pairs.groupBy(user).agg(*products)


def _products(outputs: dict[str, str], rank: int) -> Sequence:
    return [
        F.expr(f"sum(`{rating}` * CAST(features[{k}] AS DOUBLE)) AS `{prefix}_{k}`")
        for prefix, rating in outputs.items()
        for k in range(rank)
    ]
