"""Tables that replace themselves, runs that clean up, order that is proved."""

import os

import pytest
from pyspark.sql import functions as F

from churnlens.operators.materialise import materialise, run_scope
from churnlens.operators.order import PART, PLACE, order_breaks, ordered_slots
from churnlens.plans.features import write_features
from churnlens.plans.prepare import prepare
from churnlens.plans.training import choose, train
from churnlens.registry import queries as Q
from churnlens.sources.events import write_table


def test_a_table_may_replace_what_it_is_read_from(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.range(10), path)
    table = write_table(spark.read.parquet(path).where("id >= 4"), path)
    assert sorted(r[0] for r in table.collect()) == [4, 5, 6, 7, 8, 9]
    assert os.listdir(tmp_path) == ["table"]


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.range(10), path)
    with pytest.raises(Exception, match="broken"):
        write_table(spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert spark.read.parquet(path).count() == 10
    assert os.listdir(tmp_path) == ["table"]


def tables_of(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {name for name in os.listdir(folder) if name.startswith("table-")}


def test_scopes_delete_their_own_tables(spark):
    outside = materialise(spark.range(3))
    before = tables_of(spark)
    with pytest.raises(ValueError), run_scope(spark):
        inner = materialise(spark.range(4))
        with run_scope(spark):
            materialise(spark.range(5))
            assert len(tables_of(spark) - before) == 2
        assert len(tables_of(spark) - before) == 1 and inner.count() == 4
        raise ValueError
    assert tables_of(spark) == before and outside.count() == 3


def test_a_run_leaves_only_its_results(spark, sf_dir, tmp_path):
    materialise(spark.range(1))
    lines = Q._json_lines(Q.raw_events(spark, sf_dir), str(tmp_path / "events.json"))
    before = tables_of(spark)
    out = prepare(spark, lines, str(tmp_path / "run"))
    write_features(spark, out)
    train(spark, out, "linear_svm")
    assert choose(spark, out, str(tmp_path / "choice")) == "linear_svm"
    assert tables_of(spark) == before
    report = spark.read.parquet(out.load_report).first()
    raw = Q.raw_events(spark, sf_dir)
    bad = raw.where(F.col("ts") % Q.BROKEN_EVERY == 0).count()
    assert (report["lines"], report["bad_lines"]) == (raw.count() + bad, bad) and bad > 0
    assert report["valid_events"] == Q.valid(spark, sf_dir).count()


def test_breaks_in_an_order_are_counted(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("a"))
    slots = ordered_slots(rows, "a")
    assert tuple(order_breaks(slots, "a").first()) == (1000, 0)
    # Partitions swapped: every edge but what the swap happens to leave is a break.
    parts = slots.agg(F.max(PART)).first()[0]
    swapped = slots.withColumn(PART, parts - F.col(PART))
    assert order_breaks(swapped, "a").first()["breaks"] == parts
    assert order_breaks(slots.withColumn(PLACE, -F.col(PLACE)), "a").first()["breaks"] > 900
    assert tuple(order_breaks(slots.limit(0), "a").first()) == (0, 0)


def test_written_events_are_in_order(spark, sf_dir):
    slots = Q.index_events(Q.valid(spark, sf_dir), sort=True)
    numbered = slots.withColumn(PART, F.spark_partition_id()).withColumn(PLACE, F.monotonically_increasing_id())
    rows, breaks = order_breaks(materialise(numbered), "userId", "ts").first()
    assert rows == Q.cleaned(spark, sf_dir).count() and breaks == 0
