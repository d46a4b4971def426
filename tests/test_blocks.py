import statistics

import pytest

from churnlens.constants import HOURS
from churnlens.functions.scalars import name_parts
from churnlens.operators.assemble import join_tables, prefix_columns
from churnlens.operators.blocks import (
    ALL,
    LAST_WEEK,
    ROLLED_ALL,
    ROLLED_LAST_WEEK,
    age_features,
    base_counts,
    discover_values,
    hourly_counts,
    hourly_mean_length,
    length_stats,
    level_share,
    page_counts,
    page_share,
    session_features,
    user_table,
)
from churnlens.operators.clean import clean_events
from churnlens.operators.materialise import materialise
from churnlens.operators.slices import with_last_ts
from churnlens.registry import queries as Q
from churnlens.sources.clickstream import PAGES

from .helpers import START, by_key, event, events

WEEK = 8 * 24 * 3600 * 1000


def test_page_share_ignores_null_and_cancel_pages(spark):
    frame = events(
        spark,
        event(page="Home"),
        event(page="Home"),
        event(page="Thumbs Up"),
        event(page="Other"),
        event(page=None),
        event(page="Cancel"),
        event("gone", page="Cancellation Confirmation"),
    )
    table = by_key(user_table(frame, [page_share(["Home", "Thumbs Up"]), page_counts(["Home"])]))
    # A page outside the list still counts as a visit.
    assert table == {
        "u": {"userId": "u", "page_pct_all_Home": 0.5, "page_pct_all_Thumbs_Up": 0.25, "page_count_all_Home": 2}
    }
    kept = by_key(user_table(frame, [page_share(["Home"])], how="left"))
    assert kept["gone"]["page_pct_all_Home"] == 0.0


def test_page_missing_in_last_week_has_a_column_of_zeros(spark):
    frame = with_last_ts(events(spark, event(page="Home", ts=START - WEEK), event(page="NextSong")))
    row = by_key(user_table(frame, [page_counts(["Home", "NextSong"], LAST_WEEK)]))["u"]
    assert (row["page_count_lw_Home"], row["page_count_lw_NextSong"]) == (0, 1)


def test_user_with_only_cancel_pages_in_last_week_is_dropped(spark):
    frame = with_last_ts(
        events(
            spark,
            event("x", START - WEEK),
            event("x", START, page="Cancel"),
            event("y", START - WEEK),
            event("y", START),
        )
    )
    blocks = [page_share(["Home"], ALL), page_share(["Home"], LAST_WEEK)]
    assert set(by_key(user_table(frame, blocks))) == {"y"}
    marked = by_key(user_table(frame, blocks, how="left", presence={"all": blocks[:1], "both": blocks}))
    assert (marked["x"]["all"], marked["x"]["both"]) == (True, False)


def test_level_share_leaves_out_the_implied_plan(spark):
    frame = events(spark, event(level="paid"), event(level="free"), event(level="free"), event(level=None))
    row = by_key(user_table(frame, [level_share(["free", "paid"])]))["u"]
    assert row == {"userId": "u", "level_pct_all_paid": pytest.approx(1 / 3)}


def test_length_stats_of_none_one_and_many(spark):
    frame = events(
        spark,
        event("none"),
        event("one", length=3.0),
        event("many", length=1.0),
        event("many", length=4.0),
        event("many"),
    )
    table = by_key(user_table(frame, [length_stats()]))
    stats = {u: (r["song_length_all_mean"], r["song_length_all_std"]) for u, r in table.items()}
    assert stats["none"] == (0.0, 0.0)
    assert stats["one"] == (3.0, 0.0)
    assert stats["many"] == (2.5, pytest.approx(statistics.stdev([1.0, 4.0])))


def test_hours_follow_the_time_zone_and_count_all_events(spark):
    hour = 3_600_000
    frame = events(
        spark, event(ts=0, registration=0, length=2.0), event(ts=5 * hour, registration=0), event(ts=29 * hour)
    )
    row = by_key(user_table(frame, [hourly_counts(), hourly_mean_length()]))["u"]
    assert [row[f"hourly_event_counts_all_{h}"] for h in (0, 5, 6)] == [1, 2, 0]
    assert [row[f"hourly_mean_song_length_all_{h}"] for h in (0, 5)] == [2.0, 0.0]


def test_age(spark):
    frame = clean_events(events(spark, event(ts=START), event(ts=START + 86_400_000)))
    assert by_key(user_table(frame, [age_features()]))["u"] == {"userId": "u", "age": 11, "avg_age": 10.5}


def test_sessions(spark):
    frame = events(
        spark,
        event(ts=0, artist="a", length=1.0),
        event(ts=4500, artist="a", length=2.0, page=None),
        event(ts=10_000, sessionId=2, artist="b"),
        event("single", ts=0),
    )
    table = by_key(session_features(frame))
    assert table["u"]["sessions_count"] == 2
    assert table["u"]["sessions_avg_pages_accessed"] == 1.0
    assert table["u"]["sessions_avg_count_artists"] == 1.0
    assert table["u"]["sessions_avg_song_length"] == 1.5
    assert table["u"]["sessions_avg_session_time"] == 2.25
    assert table["u"]["sessions_std_session_time"] == pytest.approx(statistics.stdev([4.5, 0.0]))
    assert table["single"]["sessions_std_pages_accessed"] == 0.0


def test_values_are_discovered_and_bounded(spark):
    frame = events(spark, event(page="b"), event(page="a"), event(page=None), event(page="Cancel"))
    assert discover_values(frame, "page", excluded=["Cancel"]) == ["a", "b"]
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    try:
        with pytest.raises(ValueError, match="more than 1"):
            discover_values(frame, "page")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_colliding_names_are_numbered():
    assert name_parts(["Log-in", "Log in", "log in", "Log_in_2"]) == {
        "Log in": "Log_in", "Log-in": "Log_in_3", "log in": "log_in_4", "Log_in_2": "Log_in_2"
    }
    assert name_parts(["Home", "Thumbs Up"]) == {"Home": "Home", "Thumbs Up": "Thumbs_Up"}


def test_prefix_and_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "userId string, `n m` int")
    assert prefix_columns(left, "p").columns == ["userId", "p_n m"]
    right = spark.createDataFrame([("a", 3)], "userId string, k int")
    assert by_key(join_tables([left, right], how="left"))["b"]["k"] == 0
    assert set(by_key(join_tables([left, right]))) == {"a"}


def test_shares_and_counts_add_up(spark, sf_dir):
    rows = Q.QUERIES["page_share"](spark, sf_dir).collect()
    assert rows and all(abs(sum(r[1:]) - 1) < 1e-5 for r in rows)
    frame = Q.cleaned(spark, sf_dir)
    visits = frame.where(frame.page.isin(*PAGES)).count()
    assert visits == sum(sum(r[1:]) for r in Q.QUERIES["page_counts"](spark, sf_dir).collect())
    hours = Q.QUERIES["hourly_counts"](spark, sf_dir).collect()
    assert len(hours[0]) == len(HOURS) + 1
    assert frame.count() == sum(sum(r[1:]) for r in hours)


def test_wide_rows_are_not_shuffled(spark, sf_dir):
    """Per-user tables are joined where they were aggregated."""
    frame = Q.cleaned(spark, sf_dir)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = user_table(frame, [page_counts(PAGES), hourly_counts(), length_stats()])
        plan = table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2
    # events -> user; events -> (user, page) -> user; events -> (user, hour) -> user
    assert plan.count("Exchange") == 5


def rolled_blocks(whole, recent):
    both = []
    for period in (whole, recent):
        both += [page_share(["Home", "NextSong"], period), page_counts(["Home"], period)]
        both += [level_share(["free", "paid"], period), hourly_counts(period), hourly_mean_length(period)]
    return both


def test_rolled_blocks_equal_those_over_events(spark, sf_dir):
    frame = with_last_ts(Q.cleaned(spark, sf_dir)).cache()
    base = base_counts(frame).cache()
    plain = by_key(user_table(frame, rolled_blocks(ALL, LAST_WEEK), how="left"))
    rolled = by_key(user_table(frame, rolled_blocks(ROLLED_ALL, ROLLED_LAST_WEEK), how="left", base=base))
    assert plain.keys() == rolled.keys() and plain
    for user, row in plain.items():
        assert rolled[user].keys() == row.keys()
        assert [v for v in rolled[user].values()][1:] == pytest.approx([v for v in row.values()][1:])
    assert base.agg({"events_all": "sum"}).first()[0] == frame.count()
    assert discover_values(base, "page") == discover_values(frame, "page")


def test_rolled_blocks_of_odd_events(spark):
    frame = with_last_ts(
        events(
            spark,
            event(page="Home", ts=START - WEEK, length=2.0),
            event(page=None, level=None, length=None),
            event("b", page="Cancel", length=None),
        )
    )
    base = base_counts(frame)
    plain = by_key(user_table(frame, rolled_blocks(ALL, LAST_WEEK), how="left"))
    assert by_key(user_table(frame, rolled_blocks(ROLLED_ALL, ROLLED_LAST_WEEK), how="left", base=base)) == plain
    inner = user_table(frame, rolled_blocks(ROLLED_ALL, ROLLED_LAST_WEEK), base=base)
    assert by_key(inner) == by_key(user_table(frame, rolled_blocks(ALL, LAST_WEEK)))
    empty = frame.limit(0)
    assert user_table(empty, rolled_blocks(ROLLED_ALL, ROLLED_LAST_WEEK), base=base_counts(empty)).count() == 0
    with pytest.raises(ValueError):
        user_table(frame, [page_counts(["Home"], ROLLED_ALL)])
    with pytest.raises(TypeError):
        length_stats(ROLLED_ALL)


def test_roll_ups_share_one_shuffle_of_the_base(spark, sf_dir):
    """A user's rows of the base are put together once; pages, hours and plans need no further one."""
    frame = with_last_ts(Q.cleaned(spark, sf_dir))
    base = materialise(base_counts(frame))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = user_table(frame, [hourly_counts(ROLLED_ALL)], base=base)
        plan = table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1
