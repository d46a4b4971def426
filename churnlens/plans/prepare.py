"""From raw JSON events to clean events, last-week events and churn labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.constants import DERIVED_COLUMNS, EVENT_COLUMNS
from churnlens.operators.clean import after_registration, project_events, sort_events, valid_events, with_times
from churnlens.operators.index import attach_index, frequency_index
from churnlens.operators.labels import churn_label
from churnlens.operators.lookup import BROADCAST_BYTES, measure
from churnlens.operators.materialise import run_scope
from churnlens.operators.slices import LAST_TS, last_period
from churnlens.sources.events import observe_lines, read_json_events, read_table, write_table


# The tables of a run, each a folder of its own.
TABLES = (
    "load_report",
    "valid_events",
    "user_index",
    "artist_index",
    "events",
    "last_week_events",
    "churn",
    "user_profile",
    "reports",
    "ratings",
    "item_factors",
    "feature_columns",
    "no_lw_features",
    "features",
    "scores",
    "predictions",
    "class_report",
    "confusion",
    "coefficients",
)


@dataclass(frozen=True)
class Layout:
    """Where the tables of one run are: ``layout.events`` is ``<root>/events``."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in TABLES:
            raise AttributeError(name)
        return f"{self.root}/{name}"


def index_events(
    valid: DataFrame,
    *,
    user_index_path: str | None = None,
    artist_index_path: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    sort: bool = False,
) -> DataFrame:
    """Valid events with both indices, derived times and ``last_ts``, without the
    events from before registration.

    Ids are fitted before that filter, ``last_ts`` after it. The user's last time
    is aggregated along with the user ids, so one lookup attaches both. Artists
    come first: the user lookup then decides how the rows are laid out.

    ``sort`` orders the result by user and time. Finding the range bounds reads
    the input one more time, so that happens before the lookups if both indices are
    broadcast and leave rows where they are; only the sort inside the partitions
    comes after (Spark drops a sort below a join).
    """
    timed = with_times(valid)
    counted_ts = F.when(F.col("elapsed_days") >= 0, F.col("ts"))
    users = frequency_index(
        timed, "userId", "userIdIndex", extra={LAST_TS: F.max(counted_ts)}, path=user_index_path
    )
    artists = frequency_index(timed, "artist", "artistIndex", path=artist_index_path)
    artists_size, users_size = measure(artists), measure(users)
    stays = max(artists_size[1], users_size[1]) <= broadcast_bytes
    limit = {"broadcast_bytes": broadcast_bytes}
    kept = after_registration(timed)
    if sort and stays:
        kept = kept.repartitionByRange("userId", "ts")
    kept = attach_index(
        kept, artists, "artist", "artistIndex", invalid="keep", measured=artists_size, **limit
    )
    kept = attach_index(kept, users, "userId", "userIdIndex", measured=users_size, **limit)
    if sort:
        kept = kept.sortWithinPartitions("userId", "ts") if stays else sort_events(kept)
    return kept.select(*EVENT_COLUMNS, *DERIVED_COLUMNS, LAST_TS)


def prepare(spark: SparkSession, json_path: str, root: str, *, sort: bool = True) -> Layout:
    """Write ``load_report``, ``valid_events``, both indices, ``events``,
    ``last_week_events`` and ``churn`` under ``root``.

    The JSON is parsed once, and the lines that cannot be parsed are counted in the same
    pass: ``load_report`` has one row (``lines``, ``bad_lines``, ``valid_events``).
    Everything after reads pruned Parquet. ``events`` has ``last_ts`` next to the 18
    columns, so the last week is a filter of a scan.
    """
    out = Layout(root)
    with run_scope(spark):
        # Spark 4.1 cannot send fitted models to tasks in a session that has observed
        # something, so the pass that counts has a session of its own.
        lines, seen = observe_lines(read_json_events(spark.newSession(), json_path, keep_corrupt=True))
        write_table(valid_events(project_events(lines)), out.valid_events)
        valid = read_table(spark, out.valid_events)
        report = {**seen.get, "valid_events": valid.count()}
        row = spark.createDataFrame([report], "lines long, bad_lines long, valid_events long")
        write_table(row.coalesce(1), out.load_report)
        indexed = index_events(
            valid, user_index_path=out.user_index, artist_index_path=out.artist_index, sort=sort
        )
        events = write_table(indexed, out.events)
        write_table(last_period(events), out.last_week_events)
        write_table(churn_label(events, "userIdIndex"), out.churn)
    return out


def events_of(spark: SparkSession, out: Layout) -> tuple[DataFrame, DataFrame]:
    """Clean events and labels of a run."""
    return read_table(spark, out.events), read_table(spark, out.churn)
