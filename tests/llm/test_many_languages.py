"""Labels beyond the 64 most frequent, and ids that repeat."""

from collections import Counter

from churnlens.llm.language_id import train, training_sample
from pyspark.sql import functions as F


def test_every_language_is_learnt(spark):
    rows = [(100 * k + i, chr(0x4E00 + 50 * k) * 30, f"l{k:03}") for k in range(70) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = train(docs, held_out=F.lit(False), rounds=2)
    assert network.languages == [f"l{k:03}" for k in range(70)]


def test_a_repeated_id_gives_one_row_for_its_slot(spark):
    rows = [(1, f"text number {i} of many", "en") for i in range(500)] + [(2, "ein text", "de"), (3, "zwei", "de")]
    labelled = spark.createDataFrame(rows, "id long, text string, lang string")
    found = training_sample(labelled, per_language=256, pieces=8, max_rows=1000)
    assert Counter(lang for lang, _ in found) == {"en": 8, "de": 16}
    few = training_sample(labelled, per_language=256, pieces=8, max_rows=1)
    assert Counter(lang for lang, _ in few) == {"en": 8, "de": 8}


def test_an_empty_row_does_not_cost_a_language(spark):
    rows = [(100 * k + i, f"{chr(0x4E00 + 50 * k)}" * 30 * i, f"l{k:02}") for k in range(30) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for settings in ({}, {"per_language": 1}):
        assert train(docs, held_out=F.lit(False), rounds=2, **settings).languages == [f"l{k:02}" for k in range(30)]
