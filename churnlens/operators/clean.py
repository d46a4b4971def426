"""Cleaning of raw events: pruning, dropping unusable rows, derived times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.constants import EVENT_COLUMNS
from churnlens.functions.scalars import elapsed_days, epoch_timestamp


def project_events(raw: DataFrame) -> DataFrame:
    """Only the columns that are used, so the scan reads no others."""
    return raw.select(*EVENT_COLUMNS)


def valid_events(events: DataFrame) -> DataFrame:
    """Rows with a user and a session. A blank user id counts as none."""
    return events.where(F.col("userId").isNotNull() & (F.col("userId") != "") & F.col("sessionId").isNotNull())


def with_times(events: DataFrame) -> DataFrame:
    """Account age at the event, and both epoch columns as timestamps."""
    elapsed = F.col("ts") - F.col("registration")
    return events.withColumns(
        {
            "elapsed": elapsed,
            "timestamp": epoch_timestamp(F.col("ts")),
            "registration_date": epoch_timestamp(F.col("registration")),
            "elapsed_days": elapsed_days(elapsed),
        }
    )


def after_registration(events: DataFrame) -> DataFrame:
    """Drop events from before registration; less than half a day early is kept,
    because the age is rounded to days first."""
    return events.where(F.col("elapsed_days") >= 0)


def clean_events(raw: DataFrame) -> DataFrame:
    return after_registration(with_times(valid_events(project_events(raw))))


def sort_events(events: DataFrame) -> DataFrame:
    """Order by user and time. The range bounds use both columns, so a user with
    a large part of all events is spread over several partitions; written in this
    order, later per-user aggregates combine almost everything before a shuffle."""
    return events.orderBy("userId", "ts")
