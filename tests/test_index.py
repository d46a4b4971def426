import random

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from churnlens.operators.index import attach_index, encode_category, frequency_index

from .helpers import rows


def words(spark, values):
    return spark.createDataFrame([(v,) for v in values], "word string")


def test_order_is_frequency_then_value(spark):
    index = frequency_index(words(spark, ["b", "b", "a", "c", "c", None]), "word", "id")
    assert sorted(rows(index), key=lambda r: r[1]) == [("b", 0.0, 2), ("c", 1.0, 2), ("a", 2.0, 1)]


def test_equals_the_built_in_indexer(spark):
    rng = random.Random(1)
    frame = words(spark, [f"w{min(rng.randrange(400), rng.randrange(400))}" for _ in range(4000)]).repartition(7)
    built_in = StringIndexer(inputCol="word", outputCol="id").fit(frame)
    index = {w: i for w, i, _ in rows(frequency_index(frame, "word", "id"))}
    assert index == {w: float(i) for i, w in enumerate(built_in.labels)}


def test_null_is_kept_as_the_last_id(spark):
    frame = words(spark, ["b", "b", "a", None])
    index = frequency_index(frame, "word", "id")
    got = {r["word"]: r["id"] for r in attach_index(frame, index, "word", "id", invalid="keep").collect()}
    assert got == {"b": 0.0, "a": 1.0, None: 2.0}


def test_unknown_values_raise_or_are_skipped(spark):
    index = frequency_index(words(spark, ["a"]), "word", "id")
    assert rows(attach_index(words(spark, ["a", "x", None]), index, "word", "id", invalid="skip")) == [("a", 0.0)]
    with pytest.raises(Exception, match="no index for word: x"):
        attach_index(words(spark, ["a", "x"]), index, "word", "id").collect()


def test_index_table_is_stored(spark, tmp_path):
    path = str(tmp_path / "index")
    frame = words(spark, ["b", "b", "a"])
    index = frequency_index(frame, "word", "id", extra={"longest": F.max(F.length("word"))}, path=path)
    assert sorted(rows(index)) == [("a", 1.0, 1, 1), ("b", 0.0, 2, 1)]
    assert spark.read.parquet(path).count() == 2


def test_one_hot_drops_the_rarest(spark):
    coded = encode_category(words(spark, ["p", "p", "q"]), "word", "vector")
    assert {(r["word"], r["wordIndex"], tuple(r["vector"])) for r in coded.collect()} == {
        ("p", 0.0, (1.0,)),
        ("q", 1.0, (0.0,)),
    }
