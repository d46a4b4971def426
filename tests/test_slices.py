from churnlens.constants import DAY_MS
from churnlens.operators.labels import churn_label, churn_rate, class_weights
from churnlens.operators.slices import first_state, last_period, last_state

from .helpers import START, event, events, rows


def test_week_boundary_is_inclusive_and_per_user(spark):
    week = 7 * DAY_MS
    frame = events(
        spark,
        event("a", START),
        event("a", START - week, page="in"),
        event("a", START - week - 1, page="out"),
        event("b", START - 30 * DAY_MS, page="own last"),
    )
    got = last_period(frame)
    assert got.columns == frame.columns
    assert sorted(r["page"] for r in got.collect()) == ["Home", "in", "own last"]


def test_ties_on_the_last_time_are_decided_by_value(spark):
    frame = events(spark, event(level="free"), event(level="paid"), event(ts=START - 1, level="zzz"))
    assert rows(last_state(frame, "level")) == [("u", "paid")]
    assert rows(first_state(events(spark, event(gender="M"), event(gender="F")), "gender")) == [("u", "F")]


def test_last_state_may_be_unknown(spark):
    frame = events(spark, event(level="free"), event(ts=START + 1, level=None))
    assert rows(last_state(frame, "level")) == [("u", None)]


def test_label_rate_and_weights(spark):
    frame = events(
        spark,
        event("a", page="Cancellation Confirmation"),
        event("a"),
        event("b", page=None),
        event("c", page="Cancel"),
        event("d"),
    )
    labels = churn_label(frame)
    assert dict(rows(labels)) == {"a": 1, "b": 0, "c": 0, "d": 0}
    assert rows(churn_rate(labels)) == [(4, 1, 0.25)]
    assert dict((r["userId"], r["weights"]) for r in class_weights(labels, 0.25).collect()) == {
        "a": 0.75,
        "b": 0.25,
        "c": 0.25,
        "d": 0.25,
    }


def test_no_users_have_no_rate(spark):
    assert rows(churn_rate(churn_label(events(spark)))) == [(0, 0, None)]
