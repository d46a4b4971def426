"""Global positions of sorted rows."""

from pyspark.sql import functions as F

from churnlens.operators.order import with_position


def test_positions_follow_the_order(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 2).alias("key"))
    got = with_position(rows, "key", F.desc("a")).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(5000))
    assert [(r["key"], -r["a"]) for r in got] == sorted((r["key"], -r["a"]) for r in got)


def test_a_hot_key_spans_partitions(spark):
    rows = spark.range(4000).select(F.lit(1).alias("key"), "id")
    slots = with_position(rows, "key", "id", output="at")
    assert slots.where("at <> id").count() == 0
    assert with_position(rows.limit(0), "id").count() == 0
