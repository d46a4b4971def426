"""Each user's most recent period, and each user's first or last state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.constants import DAY_MS, RECENT_DAYS
from churnlens.operators.index import OCCURRENCES
from churnlens.operators.lookup import BROADCAST_BYTES, lookup
from churnlens.operators.materialise import materialise

LAST_TS = "last_ts"


def with_last_ts(events: DataFrame, key: str = "userId", *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add the time of the user's last event to each event.

    A window over the user would put all events of one user into one task. The
    maximum is aggregated instead (combined before the shuffle) and looked up.
    """
    known = events.where(F.col(key).isNotNull())
    last = known.groupBy(key).agg(F.max("ts").alias(LAST_TS), F.count(F.lit(1)).alias(OCCURRENCES))
    return lookup(events, materialise(last), key, weight=OCCURRENCES, broadcast_bytes=broadcast_bytes)


def is_recent(days: int = RECENT_DAYS) -> Column:
    """Whether an event with ``last_ts`` is in the user's last ``days``, inclusive."""
    return F.col("ts") >= F.col(LAST_TS) - days * DAY_MS


def last_period(events: DataFrame, key: str = "userId", days: int = RECENT_DAYS) -> DataFrame:
    """Events of each user's last ``days``, counted back from their last event."""
    if LAST_TS not in events.columns:
        events = with_last_ts(events, key)
    return events.where(is_recent(days)).drop(LAST_TS)


def last_state(events: DataFrame, column: str, key: str = "userId") -> DataFrame:
    """The value of ``column`` on the user's last event; of two values at the same
    time the greater one.

    The last time of each value comes first, as that is a hash aggregation of
    numbers; picking a value needs a sort, of the few rows that are left.
    """
    times = events.groupBy(key, column).agg(F.max("ts").alias("ts"))
    return times.groupBy(key).agg(F.max_by(column, F.struct("ts", column)).alias(column))


def first_state(events: DataFrame, column: str, key: str = "userId") -> DataFrame:
    """The value of ``column`` on the user's first event; of two values at the same
    time the smaller one."""
    times = events.groupBy(key, column).agg(F.min("ts").alias("ts"))
    return times.groupBy(key).agg(F.min_by(column, F.struct("ts", column)).alias(column))
