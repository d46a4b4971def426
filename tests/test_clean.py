import pytest

from churnlens.constants import DAY_MS, EVENT_COLUMNS
from churnlens.operators.clean import clean_events, sort_events, valid_events
from churnlens.sources.events import infer_json_events, name_table, read_json_events, write_table

from .helpers import START, event, events


def test_blank_user_null_user_and_null_session_are_dropped(spark):
    raw = events(spark, event("a"), event(""), event(None), event("b", sessionId=None))
    assert [r["userId"] for r in valid_events(raw).collect()] == ["a"]


@pytest.mark.parametrize(
    "early_days, days",
    [(0.4, 0), (0.5, None), (0.6, None), (-0.5, 1), (-2.5, 3), (-1.4999, 1), (0.0, 0)],
)
def test_age_is_rounded_before_early_events_are_dropped(spark, early_days, days):
    raw = events(spark, event(registration=START, ts=START - int(early_days * DAY_MS)))
    assert [r["elapsed_days"] for r in clean_events(raw).collect()] == ([] if days is None else [days])


def test_age_equals_decimal_rounding(spark):
    from pyspark.sql import functions as F

    from churnlens.functions.scalars import elapsed_days

    half = DAY_MS // 2
    values = [s * (k * half + d) for k in range(40) for d in (-1, 0, 1) for s in (-1, 1)]
    frame = spark.createDataFrame([(v,) for v in values], "ms long")
    expected = F.round(F.col("ms") / DAY_MS, 0).cast("int")
    assert frame.where(elapsed_days(F.col("ms")) != expected).count() == 0


def test_timestamps_are_whole_seconds(spark):
    row = clean_events(events(spark, event(ts=START + 999))).first()
    assert row["timestamp"].microsecond == 0
    assert row["elapsed"] == 10 * DAY_MS + 999


def test_sorted_by_user_and_time(spark):
    raw = events(spark, event("b", START), event("a", START + 5), event("a", START))
    assert [(r["userId"], r["ts"]) for r in sort_events(raw).collect()] == [
        ("a", START),
        ("a", START + 5),
        ("b", START),
    ]


def test_json_lines_with_broken_and_extra_content(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text(
        '{"userId":"7","sessionId":3,"ts":10,"registration":5,"page":"Home","method":"GET"}\n'
        '{"userId": broken\n'
        '{"userId":8,"sessionId":4,"ts":11,"registration":5,"length":2}\n'
    )
    got = read_json_events(spark, str(path))
    assert tuple(got.columns) == EVENT_COLUMNS
    assert sorted((r["userId"], r["length"]) for r in valid_events(got).collect()) == [("7", None), ("8", 2.0)]
    corrupt = read_json_events(spark, str(path), keep_corrupt=True).cache()
    assert corrupt.where("_corrupt_record is not null").count() == 1
    assert "method" in infer_json_events(spark, str(path)).columns


def test_tables_are_replaced_and_named(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.range(5).toDF("n"), path)
    assert write_table(spark.range(3).toDF("n"), path).count() == 3
    assert name_table(spark.read.parquet(path), "numbers").count() == 3
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 3
