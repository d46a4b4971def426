"""Descriptive reports. Each one is a small table computed by aggregation; the
label of a user is joined to facts that are aggregated per user already."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.constants import HISTOGRAM_BINS, LABEL_NAMES, SECOND_MS, SONG_PAGE
from churnlens.functions.scalars import count_where, flag
from churnlens.operators.labels import churned, with_label


def date_ranges(events: DataFrame) -> DataFrame:
    """First and last day of registration and of activity. A day is taken from the
    extreme time, once, rather than from every row."""
    return events.agg(
        F.to_date(F.min("registration_date")).alias("min_registration_date"),
        F.to_date(F.max("registration_date")).alias("max_registration_date"),
        F.to_date(F.min("timestamp")).alias("min_activity_date"),
        F.to_date(F.max("timestamp")).alias("max_activity_date"),
    )


def user_profile(events: DataFrame, labels: DataFrame | None = None, key: str = "userId") -> DataFrame:
    """One row per user: day of (first) ``registration``, day of the last event
    (``ts``), highest ``age`` and mean ``avg_age`` in days, and the label. The label is
    an aggregate of the same events, unless ``labels`` has it from elsewhere. The reports
    about users are computed from it; what one does not use is not computed.
    """
    users = events.groupBy(key).agg(
        F.to_date(F.min("registration_date")).alias("registration"),
        F.to_date(F.max("timestamp")).alias("ts"),
        F.max("elapsed_days").alias("age"),
        F.avg("elapsed_days").alias("avg_age"),
        *([churned().alias("label")] if labels is None else []),
    )
    return users if labels is None else with_label(users, labels, key)


def users_by_registration(users: DataFrame) -> DataFrame:
    """Users per day of registration and label."""
    return users.groupBy("registration", "label").agg(F.count(F.lit(1)).alias("count"))


def users_by_last_activity(users: DataFrame) -> DataFrame:
    """Users per day of their last event and label."""
    return users.groupBy("ts", "label").agg(F.count(F.lit(1)).alias("count"))


def user_age(users: DataFrame, key: str = "userId") -> DataFrame:
    """Highest and mean account age of each user, with the label."""
    return users.select(key, "age", "avg_age", "label")


def mean_age_by_day(events: DataFrame, labels: DataFrame, key: str = "userId") -> DataFrame:
    """Active users per day and label, and the mean over users of their mean age."""
    daily = events.groupBy(key, F.to_date("timestamp").alias("ts")).agg(F.avg("elapsed_days").alias("age"))
    daily = with_label(daily, labels, key)
    return daily.groupBy("ts", "label").agg(F.count(key).alias("users"), F.avg("age").alias("age"))


def activity_by_age_day(events: DataFrame, labels: DataFrame, key: str = "userId") -> DataFrame:
    """Songs and other interactions per user and age day, summed up per age day
    and label. An event without a page counts as another interaction."""
    song = F.col("page") == SONG_PAGE
    daily = events.groupBy(key, F.col("elapsed_days").alias("user_age_when_played")).agg(
        count_where(song).alias("songs_played"),
        F.sum(F.lit(1) - flag(song)).alias("page_interactions"),
    )
    daily = with_label(daily, labels, key)
    measures = [
        how(what).alias(f"{prefix}{what}")
        for what in ("songs_played", "page_interactions")
        for prefix, how in (("", F.sum), ("avg_", F.avg), ("std_", F.stddev_samp))
    ]
    report = daily.groupBy("user_age_when_played", "label").agg(F.count(key).alias("users_count"), *measures)
    return report.orderBy("user_age_when_played", "label")


def sessions_by_day(
    events: DataFrame, labels: DataFrame, key: str = "userId", session: str = "sessionId"
) -> DataFrame:
    """Sessions per starting age day and label, with mean events and mean seconds.

    Sessions are summed up per user and day before the label is joined, so a user
    with a large part of all sessions is a few rows by then, and the sums stay
    whole milliseconds until the last division.
    """
    facts = events.groupBy(key, session).agg(
        F.min("elapsed_days").alias("activity_time"),
        F.count(session).alias("interactions"),
        (F.max("ts") - F.min("ts")).alias("millis"),
    )
    daily = facts.groupBy(key, "activity_time").agg(
        F.count(session).alias("sessions"),
        F.sum("interactions").alias("interactions"),
        F.sum("millis").alias("millis"),
    )
    total = with_label(daily, labels, key).groupBy("activity_time", "label")
    sessions = F.sum("sessions")
    report = total.agg(
        sessions.alias("sessions"),
        (F.sum("interactions") / sessions).alias("interactions"),
        (F.sum("millis") / SECOND_MS / sessions).alias("session_time"),
    )
    return report.orderBy("activity_time", "label")


def chart_table(
    report: DataFrame, index: str, measures: Sequence[str] | None = None, names: dict[int, str] | None = None
) -> DataFrame:
    """One row per index value, one column per measure and label, 0 where missing.
    Columns are called ``<measure> <label name>``."""
    names = names or LABEL_NAMES
    measures = list(measures or [c for c in report.columns if c not in (index, "label")])
    wide = report.groupBy(index).agg(
        *[
            F.max(F.when(F.col("label") == label, F.col(measure))).alias(f"{measure} {name}")
            for measure in measures
            for label, name in names.items()
        ]
    )
    return wide.na.fill(0).orderBy(index)


def cumulative(chart: DataFrame, index: str) -> DataFrame:
    """Add the running total of every other column, as ``cumulative <column>``.
    The chart has one row per calendar day, so the window is that small."""
    so_far = Window.orderBy(index).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {f"cumulative {c}": F.sum(f"`{c}`").over(so_far) for c in chart.columns if c != index}
    return chart.withColumns(totals)


def of_label(users: DataFrame, label: int, column: str) -> DataFrame:
    """One column of the users with one label."""
    return users.where(F.col("label") == label).select(column)


def histogram(users: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of a column per label, over that label's own range.

    A bin includes its lower edge, the last one both. A range of one value gets
    half a unit on either side. Every label has all bins, with 0 where no user falls.
    """
    x = F.col(column).cast("double")
    known = users.where(F.col(column).isNotNull() & F.col("label").isin(*LABEL_NAMES))
    ranges = known.groupBy("label").agg(F.min(x).alias("low"), F.max(x).alias("high"))
    pad = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    ranges = ranges.select("label", (F.col("low") - pad).alias("low"), (F.col("high") + pad).alias("high"))
    # `ranges` has one row per class label, two at most.
    placed = known.join(F.broadcast(ranges), "label").select("label", x.alias("x"), "low", "high")
    width = (F.col("high") - F.col("low")) / bins

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.col("high")).otherwise(F.col("low") + i * width)

    guess = F.floor((F.col("x") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    placed = placed.withColumn("bin", F.least(guess, F.lit(bins - 1)))
    # The quotient may land one bin off a value that sits on an edge.
    fitted = (
        F.when(F.col("x") < edge(F.col("bin")), F.col("bin") - 1)
        .when((F.col("x") >= edge(F.col("bin") + 1)) & (F.col("bin") < bins - 1), F.col("bin") + 1)
        .otherwise(F.col("bin"))
    )
    placed = placed.withColumn("bin", fitted.cast("int"))
    counts = placed.groupBy("label", "bin").agg(F.count(F.lit(1)).alias("users"))
    every = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    complete = ranges.select("label", "low", "high", every).join(counts, ["label", "bin"], "left")
    counts = complete.select(
        "label",
        "bin",
        edge(F.col("bin")).alias("bin_low"),
        edge(F.col("bin") + 1).alias("bin_high"),
        F.coalesce("users", F.lit(0)).cast("long").alias("users"),
    )
    return counts.orderBy("label", "bin")
