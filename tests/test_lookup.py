"""The ways of attaching a table agree, also when a third of the rows share a key."""

import pytest
from pyspark.sql import functions as F

from churnlens.operators.lookup import heavy_keys, lookup, measure
from churnlens.operators.materialise import materialise
from churnlens.operators.slices import with_last_ts

from .helpers import rows


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.concat(F.lit("k"), F.col("id") % 97))
    return spark.range(3000).select(key.alias("key"), F.col("id").alias("ts")).repartition(6).cache()


@pytest.fixture(scope="module")
def table(skewed):
    known = skewed.where("key <> 'k5'").groupBy("key")
    return materialise(known.agg(F.max("ts").alias("top"), F.count("*").alias("n")))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("weight", ["n", None])
def test_salted_lookup_equals_plain_join(skewed, table, how, weight):
    wanted = table if weight is None else table.drop("n")
    plain = skewed.join(wanted, "key", how)
    split = lookup(skewed, table, "key", how=how, weight=weight, broadcast_bytes=0)
    assert split.columns == plain.columns
    assert sorted(rows(split), key=repr) == sorted(rows(plain), key=repr)
    small = lookup(skewed, table, "key", how=how, weight=weight)
    assert sorted(rows(small), key=repr) == sorted(rows(plain), key=repr)


def test_heavy_key_without_a_match(skewed, table):
    other = materialise(table.where("key <> 'hot'"))
    for how in ("left", "inner"):
        plain = skewed.join(other.drop("n"), "key", how)
        split = lookup(skewed, other.drop("n"), "key", how=how, broadcast_bytes=0)
        assert sorted(rows(split), key=repr) == sorted(rows(plain), key=repr)


@pytest.fixture
def plain_plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_are_read_once(spark, skewed, table, plain_plans):
    stored = materialise(skewed)
    split = lookup(stored, table, "key", weight="n", broadcast_bytes=0)
    split.collect()
    plan = split._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    read = [line for line in plan.splitlines() if "FileScan" in line and "ts#" in line]
    assert len(read) == 1
    assert "SortMergeJoin" in plan


def test_a_heavy_key_is_spread(spark, skewed, table, plain_plans):
    heavy = heavy_keys(skewed, table, "key", "n", 8).collect()
    assert [(r[0], r[1] > 1) for r in heavy] == [("hot", True)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split = lookup(skewed, table, "key", weight="n", broadcast_bytes=0)
        held = split.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(held) > 1
    assert sum(r["count"] for r in held) == skewed.where("key = 'hot'").count()


def test_many_equally_heavy_keys(spark, plain_plans):
    even = spark.range(20_000).select((F.col("id") % 2000).alias("key"), "id")
    known = materialise(even.groupBy("key").agg(F.sum("id").alias("top"), F.count("*").alias("n")))
    assert heavy_keys(even, known, "key", "n", 8).count() == 0
    assert heavy_keys(even, known, "key", None, 4000).count() == 2000
    got = lookup(even, known, "key", weight="n", broadcast_bytes=0)
    assert got.count() == 20_000
    assert sorted(rows(got)) == sorted(rows(even.join(known.drop("n"), "key")))


def test_measure_counts_text(spark):
    frame = spark.createDataFrame([("abc", [1.0, 2.0]), (None, None)], "s string, a array<double>")
    count, size = measure(frame)
    assert count == 2
    assert size == 2 * (32 + 16) + 3 + 16


def test_last_time_is_the_same_both_ways(skewed):
    small = with_last_ts(skewed, "key")
    split = with_last_ts(skewed, "key", broadcast_bytes=0)
    assert sorted(rows(small), key=repr) == sorted(rows(split), key=repr)
