"""The wide per-user feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.constants import ALS_BLOCKS, ALS_RANK, CANCEL_PAGES
from churnlens.operators.assemble import assemble_features, join_tables, stored_key, whole_key
from churnlens.operators.blocks import (
    ALL,
    LAST_WEEK,
    ROLLED_ALL,
    ROLLED_LAST_WEEK,
    age_features,
    base_counts,
    discover_values,
    period_blocks,
    session_features,
    user_table,
)
from churnlens.operators.labels import churned
from churnlens.operators.materialise import materialise, run_scope
from churnlens.operators.ratings import item_factors, latent_features, period_ratings, rated
from churnlens.plans.prepare import Layout
from churnlens.sources.events import read_table, write_table

LATENT_ALL, LATENT_LAST_WEEK = "als_all", "als_lw"
USER_INDEX, ARTIST_INDEX = "userIdIndex", "artistIndex"

# The event columns that features are computed from.
FEATURE_INPUTS = (
    "userIdIndex",
    "artistIndex",
    "sessionId",
    "level",
    "page",
    "artist",
    "song",
    "length",
    "ts",
    "elapsed_days",
    "last_ts",
)
IN_ALL, IN_LAST_WEEK = "in_all", "in_last_week"

_LAST_WEEK_PREFIXES = tuple(
    f"{block}_{LAST_WEEK.name}_"
    for block in (
        "als",
        "page_pct",
        "page_count",
        "level_pct",
        "song_length",
        "hourly_event_counts",
        "hourly_mean_song_length",
    )
)


def feature_events(events: DataFrame) -> DataFrame:
    """Indexed events as features need them: few columns, ids as whole numbers."""
    return whole_key(whole_key(events.select(*FEATURE_INPUTS), USER_INDEX), ARTIST_INDEX)


def feature_columns(
    events: DataFrame,
    latent: DataFrame,
    base: DataFrame,
    pages: Sequence[str],
    levels: Sequence[str],
    *,
    key: str = USER_INDEX,
) -> DataFrame:
    """Features of both periods and the label, for every user with latent features.

    ``base`` is the written ``base_counts`` of the events, which page, plan and hour
    features are rolled up from. ``in_all`` and ``in_last_week`` say in which feature
    tables the user belongs: one that lacks a block in the period is in neither table
    of that period.
    """
    whole = [*period_blocks(pages, levels, ALL, ROLLED_ALL), age_features()]
    recent = period_blocks(pages, levels, LAST_WEEK, ROLLED_LAST_WEEK)
    table = user_table(
        events,
        whole + recent,
        key,
        how="left",
        extra={"label": churned()},
        presence={IN_ALL: whole, IN_LAST_WEEK: whole + recent},
        base=base,
    )
    return join_tables([latent, table, session_features(events, key)], key)


def whole_period(table: DataFrame) -> DataFrame:
    """Features over the whole log, of the users that have all of them."""
    columns = [c for c in table.columns if not c.startswith(_LAST_WEEK_PREFIXES)]
    return table.where(F.col(IN_ALL)).select(*columns).drop(IN_ALL, IN_LAST_WEEK)


def both_periods(table: DataFrame) -> DataFrame:
    """Features over the whole log and the last week, of the users that have all."""
    return table.where(F.col(IN_LAST_WEEK)).drop(IN_ALL, IN_LAST_WEEK)


def write_features(
    spark: SparkSession,
    out: Layout,
    *,
    rank: int = ALS_RANK,
    user_blocks: int = ALS_BLOCKS,
    item_blocks: int = ALS_BLOCKS,
) -> tuple[DataFrame, DataFrame]:
    """Write ``no_lw_features`` (whole log) and ``features`` (with last week).

    The blocks are those of the item factorisation and part of what it gives.

    Events are scanned four times: for ratings, sessions, the base of all page, plan
    and hour features, and ages and lengths. Ratings, the base and the feature columns
    are read more than once, so they are written.
    """
    with run_scope(spark):
        events = feature_events(read_table(spark, out.events))
        key, item = USER_INDEX, ARTIST_INDEX
        ratings = write_table(rated(period_ratings(events, key, item)), out.ratings)
        blocks = {"user_blocks": user_blocks, "item_blocks": item_blocks}
        factors = write_table(item_factors(ratings, key, item, rank=rank, **blocks), out.item_factors)
        prefixes = {LATENT_ALL: "rating", LATENT_LAST_WEEK: "recent_rating"}
        latent = latent_features(ratings, factors, prefixes, key, item, rank=rank)

        base = materialise(base_counts(events, key))
        pages = discover_values(base, "page", excluded=CANCEL_PAGES)
        levels = discover_values(base, "level")
        table = feature_columns(events, latent, base, pages, levels, key=key)
        table = write_table(stored_key(table, key), out.feature_columns)
        without = write_table(assemble_features(whole_period(table), key), out.no_lw_features)
        full = write_table(assemble_features(both_periods(table), key), out.features)
    return without, full
