"""All descriptive reports of a run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlens.operators import reports as R
from churnlens.operators.assemble import whole_key
from churnlens.plans.prepare import Layout, events_of
from churnlens.sources.events import write_table

KEY = "userIdIndex"


def report_tables(
    events: DataFrame, labels: DataFrame, users: DataFrame, key: str = KEY
) -> dict[str, Callable[[], DataFrame]]:
    """Chart tables by name. ``users`` are the profiles of the users in ``events``."""
    return {
        "date_ranges": lambda: R.date_ranges(events),
        "users_by_registration_date": lambda: R.cumulative(
            R.chart_table(R.users_by_registration(users), "registration"), "registration"
        ),
        "users_by_last_activity_date": lambda: R.cumulative(
            R.chart_table(R.users_by_last_activity(users), "ts"), "ts"
        ),
        "mean_age_by_activity_date": lambda: R.chart_table(R.mean_age_by_day(events, labels, key), "ts"),
        "users_by_age": lambda: R.histogram(users, "age"),
        "users_by_mean_age": lambda: R.histogram(users, "avg_age"),
        "activity_by_age_day": lambda: R.chart_table(
            R.activity_by_age_day(events, labels, key), "user_age_when_played"
        ),
        "sessions_by_activity_day": lambda: R.chart_table(R.sessions_by_day(events, labels, key), "activity_time"),
    }


def write_reports(spark: SparkSession, out: Layout) -> dict[str, DataFrame]:
    """Write every chart table under ``reports``; they are a row per day or bin.
    Four of them are about users, and read the written profiles."""
    events, labels = (whole_key(table, KEY) for table in events_of(spark, out))
    users = write_table(R.user_profile(events, key=KEY), out.user_profile)
    tables = report_tables(events, labels, users)
    return {name: write_table(build().coalesce(1), f"{out.reports}/{name}") for name, build in tables.items()}
