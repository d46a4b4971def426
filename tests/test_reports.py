import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from churnlens.operators import reports as R
from churnlens.operators.clean import clean_events
from churnlens.operators.labels import churn_label

from .helpers import START, event, events, rows

DAY = 86_400_000


def labelled(frame):
    return frame, churn_label(frame)


def test_null_page_is_an_interaction(spark):
    frame = clean_events(events(spark, event(page=None), event(page="NextSong"), event(page="Home")))
    row = R.activity_by_age_day(*labelled(frame)).first()
    assert (row["songs_played"], row["page_interactions"], row["users_count"]) == (1, 2, 1)
    assert row["std_songs_played"] is None


def test_mean_age_is_a_mean_of_user_means(spark):
    frame = clean_events(
        events(
            spark,
            event("a", START),
            event("a", START + 1),
            event("a", START + 2),
            event("b", START, registration=START - 20 * DAY),
        )
    )
    assert rows(R.mean_age_by_day(*labelled(frame)).select("users", "age")) == [(2, 15.0)]


def test_chart_has_all_labels_and_running_totals(spark):
    report = spark.createDataFrame(
        [("2024-01-02", 0, 5), ("2024-01-01", 1, 2), ("2024-01-01", 0, 1)], "day string, label int, count long"
    )
    chart = R.cumulative(R.chart_table(report, "day"), "day")
    assert chart.columns == [
        "day",
        "count Not Cancelled",
        "count Cancelled",
        "cumulative count Not Cancelled",
        "cumulative count Cancelled",
    ]
    assert rows(chart) == [("2024-01-01", 1, 2, 1, 2), ("2024-01-02", 5, 0, 6, 2)]


def test_sessions_are_weighted_equally(spark):
    frame = clean_events(
        events(
            spark,
            event("a", START, sessionId=1),
            event("a", START + 3000, sessionId=1),
            event("a", START, sessionId=2),
            event("b", START, sessionId=1),
        )
    )
    assert rows(R.sessions_by_day(*labelled(frame))) == [(10, 0, 3, pytest.approx(4 / 3), 1.0)]


def test_date_ranges_and_users_by_date(spark):
    frame = clean_events(
        events(spark, event("a", START), event("a", START + 2 * DAY), event("b", START, page="Cancellation Confirmation"))
    )
    row = R.date_ranges(frame).first()
    assert (row["max_activity_date"] - row["min_activity_date"]).days == 2
    users = R.user_profile(*labelled(frame))
    assert sorted((r["label"], r["count"]) for r in R.users_by_registration(users).collect()) == [(0, 1), (1, 1)]
    last = {r["label"]: r["ts"] for r in R.users_by_last_activity(users).collect()}
    assert (last[0] - last[1]).days == 2
    ages = R.user_age(users)
    assert rows(R.of_label(ages, 1, "age")) == [(10,)]


def bins(spark, values, label=0):
    frame = spark.createDataFrame([(label, float(v)) for v in values], "label int, age double")
    return {r["bin"]: (r["users"], r["bin_low"], r["bin_high"]) for r in R.histogram(frame, "age").collect()}


def test_equal_ages_share_the_middle_bin(spark):
    got = bins(spark, [4, 4, 4])
    assert got[5] == (3, 4.0, pytest.approx(4.1))
    assert {b: n for b, (n, _, _) in got.items()} == {b: 3 * (b == 5) for b in range(10)}


def test_each_label_has_its_own_range(spark):
    frame = spark.createDataFrame([(0, 0), (0, 10), (1, 100), (1, 200), (0, None)], "label int, age int")
    got = [(r["label"], r["bin"], r["users"]) for r in R.histogram(frame, "age").collect()]
    assert got == [(label, b, int(b in (0, 9))) for label in (0, 1) for b in range(10)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 700).map(lambda n: n / 7) | st.integers(0, 90), min_size=1, max_size=60))
def test_bins_equal_numpy(spark, values):
    counts, edges = np.histogram(np.array(values, dtype=float), bins=10)
    got = bins(spark, values)
    assert {b: n for b, (n, _, _) in got.items()} == {b: int(n) for b, n in enumerate(counts)}
    assert sum(n for n, _, _ in got.values()) == len(values)
    for b, (_, low, high) in got.items():
        assert low == pytest.approx(edges[b]) and high == pytest.approx(edges[b + 1])
