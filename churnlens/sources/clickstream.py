"""A generic event table seen as a music-service click log.

The input has ``event_id, ts, user_id, event_type, value, props``; sessions,
plans, pages and songs are derived from them by fixed formulas, so that every
operator can be run over that table. All of it is a projection of one scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.constants import DAY_MS

# The first day of the log and the first day of registration.
FIRST_DAY_MS = 1704067200000
FIRST_REGISTRATION_MS = 1703030400000

# Pages and plans that the formulas can produce.
PAGES = ("Add to Playlist", "Error", "Home", "NextSong", "Thumbs Up", "Upgrade")
LEVELS = ("free", "paid")


def clickstream(events: DataFrame) -> DataFrame:
    # `props` is {"k": n}. Cutting the number out is cheap enough to be repeated where
    # a filter on it is pushed down; a regular expression or JSON path is not.
    number = F.substring_index(F.substring_index("props", ": ", -1), "}", 1)
    events = events.withColumns(
        {
            "k": number.try_cast("long"),
            "ms": F.unix_millis(F.col("ts").cast("timestamp")),
        }
    )
    user, kind, value, k, ms = (F.col(c) for c in ("user_id", "event_type", "value", "k", "ms"))
    view = kind == "view"

    user_id = F.when(user == 0, "").when(user != 1, user.cast("string"))
    level = F.when(user % 3 == 0, "paid").when((user % 3 == 1) | (k < 50), "free").otherwise("paid")
    error_page = (
        F.when(value >= 150, "Cancellation Confirmation").when(value >= 100, "Cancel").otherwise("Error")
    )
    page = (
        F.when(view, "NextSong")
        .when(kind == "click", F.when(k < 50, "Home").otherwise("Thumbs Up"))
        .when(kind == "signup", "Add to Playlist")
        .when(kind == "purchase", "Upgrade")
        .when(kind == "error", error_page)
    )
    return events.select(
        user_id.alias("userId"),
        F.when(user % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit("city_"), (user % 10).cast("string")).alias("location"),
        level.alias("level"),
        F.when(k != 0, F.floor((ms - FIRST_DAY_MS) / DAY_MS)).alias("sessionId"),
        page.alias("page"),
        F.when(view, F.concat(F.lit("artist_"), (k % 20).cast("string"))).alias("artist"),
        F.when(view & (k % 7 != 0), F.concat(F.lit("song_"), (F.col("event_id") % 500).cast("string"))).alias("song"),
        F.when(view, value).alias("length"),
        F.lit("ua").alias("userAgent"),
        (F.lit(FIRST_REGISTRATION_MS) + (user % 25) * DAY_MS).alias("registration"),
        ms.alias("ts"),
    )
