"""Per-user feature blocks.

A block describes aggregates and the feature columns computed from them;
``user_table`` evaluates any number of blocks together. A period is a condition
inside the aggregates, so features of the whole log and of each user's last week
come out of the same scan.

A block with one column per page or hour aggregates twice: events per (user,
value), which keeps the rows narrow while they are many, then the few rows of a
user into one wide row. Aggregating straight into the wide row would shuffle all
its columns, nearly all of them 0, for every task that sees the user.

Blocks that need nothing finer than page, plan and hour can also be rolled up from
``base_counts``, one narrow table of the events, instead of scanning them each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.constants import BASE_LEVEL, CANCEL_PAGES, HOURS
from churnlens.functions.scalars import count_where, hour_of_day, name_parts, seconds_between, share
from churnlens.operators.assemble import join_tables
from churnlens.operators.slices import is_recent

HOUR = "hour"
RECENT = "recent"
BASE_KEYS = ("page", "level", HOUR)


@dataclass(frozen=True)
class Period:
    """Which events count: all of them, or those where column ``flag`` is true."""

    name: str
    flag: str | None = None

    rolled = False

    def count(self, condition: Column | None = None) -> Column:
        """Aggregate: events of the period (that fulfil the condition)."""
        if self.flag is not None:
            condition = F.col(self.flag) if condition is None else F.col(self.flag) & condition
        return F.count(F.lit(1)) if condition is None else count_where(condition)

    def value(self, column: str) -> Column:
        """The column, NULL outside the period."""
        return F.col(column) if self.flag is None else F.when(F.col(self.flag), F.col(column))

    def mean(self, column: str) -> Column:
        """Aggregate: mean of the column over the events of the period."""
        return F.avg(self.value(column))


@dataclass(frozen=True)
class RolledPeriod(Period):
    """The same period where a row of ``base_counts`` stands for many events."""

    rolled = True

    @property
    def events(self) -> str:
        return f"events_{self.name}"

    def count(self, condition: Column | None = None) -> Column:
        events = F.col(self.events)
        return F.sum(events if condition is None else F.when(condition, events).otherwise(0))

    def value(self, column: str) -> Column:
        raise TypeError(f"{column} is not known for each event in base_counts")

    def mean(self, column: str) -> Column:
        return F.try_divide(F.sum(f"{column}_sum_{self.name}"), F.sum(f"{column}_n_{self.name}"))


ALL = Period("all")
LAST_WEEK = Period("lw", RECENT)
ROLLED_ALL = RolledPeriod("all")
ROLLED_LAST_WEEK = RolledPeriod("lw", RECENT)


@dataclass(frozen=True)
class Block:
    """Features of a user.

    Without a ``dimension``, ``aggregates`` run over the events of a user. With
    one, ``measures`` run over the events per (user, dimension value) and
    ``aggregates`` over those results. ``features`` are computed from the
    aggregates. A user is part of the block when aggregate ``present`` is above 0.
    A ``rolled`` block runs over the rows of ``base_counts`` instead of events.
    """

    aggregates: dict[str, Column]
    features: dict[str, Column]
    present: str | None = None
    dimension: str | None = None
    measures: dict[str, Column] = field(default_factory=dict)
    rolled: bool = False


def eligible_page(excluded: Sequence[str] = CANCEL_PAGES) -> Column:
    """Page visits that may serve as features: the pages that define the label may not."""
    return F.col("page").isNotNull() & ~F.col("page").isin(*excluded)


def _pages(
    pages: Sequence[str],
    period: Period,
    excluded: Sequence[str],
    prefix: str,
    feature: Callable[[Column, Column], Column],
) -> Block:
    visits, total = f"__visits_{period.name}", f"__pages_{period.name}"
    aggregates = {total: F.sum(F.when(eligible_page(excluded), F.col(visits)).otherwise(0))}
    features = {}
    for page, part in name_parts(pages).items():
        count = f"__page_{period.name}_{part}"
        aggregates[count] = F.max(F.when(F.col("page") == page, F.col(visits)))
        features[f"{prefix}_{period.name}_{part}"] = feature(F.coalesce(count, F.lit(0)), F.col(total))
    return Block(aggregates, features, total, "page", {visits: period.count()}, period.rolled)


def page_share(pages: Sequence[str], period: Period = ALL, excluded: Sequence[str] = CANCEL_PAGES) -> Block:
    """Part of a user's page visits that went to each page."""

    def part(count: Column, total: Column) -> Column:
        return F.coalesce(share(count, total), F.lit(0.0))

    return _pages(pages, period, excluded, "page_pct", part)


def page_counts(pages: Sequence[str], period: Period = ALL, excluded: Sequence[str] = CANCEL_PAGES) -> Block:
    """A user's visits to each page."""
    return _pages(pages, period, excluded, "page_count", lambda count, total: count)


def level_share(levels: Sequence[str], period: Period = ALL, dropped: str = BASE_LEVEL) -> Block:
    """Part of a user's events on each plan, without the plan the others imply."""
    total = f"__levels_{period.name}"
    aggregates = {total: period.count(F.col("level").isNotNull())}
    features = {}
    for level, part in name_parts(v for v in levels if v != dropped).items():
        count = f"__level_{period.name}_{part}"
        aggregates[count] = period.count(F.col("level") == level)
        features[f"level_pct_{period.name}_{part}"] = F.coalesce(share(F.col(count), F.col(total)), F.lit(0.0))
    return Block(aggregates, features, total, rolled=period.rolled)


def length_stats(period: Period = ALL) -> Block:
    """Mean and sample deviation of song length; 0 when there is none, or only one."""
    name, seen = f"song_length_{period.name}", f"__events_{period.name}"
    length = period.value("length")
    aggregates = {
        seen: period.count(),
        f"__{name}_mean": F.avg(length),
        f"__{name}_std": F.stddev_samp(length),
    }
    features = {f"{name}_{f}": F.coalesce(f"__{name}_{f}", F.lit(0.0)) for f in ("mean", "std")}
    return Block(aggregates, features, seen)


def _hours(period: Period, hours: Sequence[int], name: str, measure: str, how: Column, missing: str) -> Block:
    # As text: two calls to the JVM per column instead of ten, for 24 columns a block.
    events, seen = f"__hour_events_{period.name}", f"__hours_{period.name}"
    aggregates = {seen: F.sum(events)}
    features = {}
    for hour in hours:
        column = f"{name}_{period.name}_{hour}"
        aggregates[f"__{column}"] = F.expr(f"max(CASE WHEN {HOUR} = {hour} THEN {measure} END)")
        features[column] = F.expr(f"coalesce(__{column}, {missing})")
    return Block(aggregates, features, seen, HOUR, {events: period.count(), measure: how}, period.rolled)


def hourly_counts(period: Period = ALL, hours: Sequence[int] = HOURS) -> Block:
    """A user's events (of every kind, not only songs) in each hour of the day."""
    events = f"__hour_events_{period.name}"
    return _hours(period, hours, "hourly_event_counts", events, period.count(), "0")


def hourly_mean_length(period: Period = ALL, hours: Sequence[int] = HOURS) -> Block:
    """Mean song length in each hour of the day, 0 where nothing was played."""
    mean = f"__hour_length_{period.name}"
    return _hours(period, hours, "hourly_mean_song_length", mean, period.mean("length"), "0D")


def age_features() -> Block:
    """Highest and mean account age over a user's events, in days."""
    aggregates = {"__age": F.max("elapsed_days"), "__avg_age": F.avg("elapsed_days")}
    return Block(aggregates, {"age": F.col("__age"), "avg_age": F.col("__avg_age")})


def period_blocks(
    pages: Sequence[str], levels: Sequence[str], period: Period, counted: Period | None = None
) -> list[Block]:
    """The blocks that exist once per period. Those that can be rolled up are, when
    ``counted`` is the period's rolled form; the deviation of lengths needs each event."""
    counted = counted or period
    return [
        page_share(pages, counted),
        page_counts(pages, counted),
        level_share(levels, counted),
        length_stats(period),
        hourly_counts(counted),
        hourly_mean_length(counted),
    ]


def base_counts(events: DataFrame, key: str = "userId") -> DataFrame:
    """Events per (user, page, plan, hour) of both periods: how many, how many with a
    length, and the sum of lengths. What page, plan and hour blocks need, in one scan.

    A user has as many rows as combinations at most, whatever the number of events.
    Events need ``last_ts``.
    """
    inputs = _with_derived(events)
    measures = {}
    for period, rolled in ((ALL, ROLLED_ALL), (LAST_WEEK, ROLLED_LAST_WEEK)):
        measures[rolled.events] = period.count()
        measures[f"length_sum_{period.name}"] = F.sum(period.value("length"))
        measures[f"length_n_{period.name}"] = F.count(period.value("length"))
    return inputs.groupBy(key, *BASE_KEYS).agg(*_aliased(measures))


def _with_derived(events: DataFrame) -> DataFrame:
    inputs = events.withColumn(HOUR, hour_of_day(F.col("ts")))
    return inputs.withColumn(RECENT, is_recent()) if "last_ts" in events.columns else inputs


def user_table(
    events: DataFrame,
    blocks: Iterable[Block],
    key: str = "userId",
    *,
    how: str = "inner",
    extra: dict[str, Column] | None = None,
    presence: dict[str, Iterable[Block]] | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """Evaluate blocks for every user, one aggregation per dimension.

    ``inner`` keeps only users that are part of every block (as a join of the
    blocks would); ``left`` keeps all users, with 0 for what is missing. ``extra``
    adds plain aggregates. ``presence`` adds boolean columns that say whether the
    user is part of all the named blocks. Events need ``last_ts`` when a block is
    limited to the last week. ``base`` is the ``base_counts`` of the events (written,
    as it is read for each dimension); rolled blocks need it.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    blocks, extra = list(blocks), dict(extra or {})
    if base is None and any(block.rolled for block in blocks):
        raise ValueError("rolled blocks need base_counts")
    inputs = _with_derived(events)
    # A user has a bounded number of rows in the base, so they can be put together;
    # every roll-up then runs where they are.
    counted = None if base is None else base.repartition(F.col(key))

    by_source: dict[tuple[bool, str | None], list[Block]] = {(False, None): []} if extra else {}
    for block in blocks:
        by_source.setdefault((block.rolled, block.dimension), []).append(block)
    parts = []
    for (rolled, dimension), members in by_source.items():
        aggregates = {} if rolled or dimension is not None else dict(extra)
        for block in members:
            aggregates.update(block.aggregates)
        rows = counted if rolled else inputs
        if dimension is not None:
            measures = {name: column for block in members for name, column in block.measures.items()}
            rows = rows.groupBy(key, dimension).agg(*_aliased(measures))
            if not rolled:
                # A user has one row per value by now, so they can be put together:
                # the wide row is then built where its parts are, and never shuffled.
                rows = rows.repartition(F.col(key))
        parts.append(rows.groupBy(key).agg(*_aliased(aggregates)))
    # Every part has all users, partitioned by user.
    table = join_tables(parts, key)

    if how == "inner":
        table = table.where(_in_all(blocks))
    features = {name: column for block in blocks for name, column in block.features.items()}
    marks = {name: _in_all(list(group)) for name, group in (presence or {}).items()}
    return table.select(key, *extra, *_aliased(features), *_aliased(marks))


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _in_all(blocks: list[Block]) -> Column:
    condition = F.lit(True)
    for name in dict.fromkeys(b.present for b in blocks if b.present):
        condition = condition & (F.col(name) > 0)
    return condition


def discover_values(events: DataFrame, column: str, excluded: Sequence[str] = ()) -> list:
    """Sorted distinct values of a column with few of them, for ``pages``/``levels``.

    Refuses a column with more values than Spark's own pivot would accept."""
    limit = int(events.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    values = events.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()
    if len(values) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values")
    return sorted(row[0] for row in values if row[0] not in excluded)


# Measures of one session, averaged and spread per user, and the names of both.
_SESSION_MEASURES = {
    "pages_accessed": ("avg_pages_accessed", "std_pages_accessed"),
    "count_artists": ("avg_count_artists", "std_count_artists"),
    "avg_song_length": ("avg_song_length", "std_song_length"),
    "session_time": ("avg_session_time", "std_session_time"),
}


def session_features(events: DataFrame, key: str = "userId", session: str = "sessionId") -> DataFrame:
    """Number of sessions and mean / sample deviation of four session measures."""
    per_session = events.groupBy(key, session).agg(
        F.count("page").alias("pages_accessed"),
        F.count_distinct("artist").alias("count_artists"),
        F.avg("length").alias("avg_song_length"),
        seconds_between(F.min("ts"), F.max("ts")).alias("session_time"),
    )
    means = [F.avg(m).alias(f"sessions_{avg}") for m, (avg, _) in _SESSION_MEASURES.items()]
    spreads = [F.stddev_samp(m).alias(f"sessions_{std}") for m, (_, std) in _SESSION_MEASURES.items()]
    per_user = per_session.groupBy(key).agg(F.count(session).alias("sessions_count"), *means, *spreads)
    return per_user.na.fill(0.0)
