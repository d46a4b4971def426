"""The suffix tree keeps on disk only the tables that its later steps read."""

from pathlib import Path
from urllib.parse import urlparse

from churnlens.llm.suffix_tree_lm import DEPTH, DIVERGENCE, suffix_tree
from churnlens.operators.materialise import materialise

from .cases import table


def _tables(spark):
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    return {p.name for p in folder.glob("table-*")}


def test_tree_leaves_only_its_two_tables(spark):
    docs = table(spark, [(i, f"the tree of text {i % 7} and more words {i}") for i in range(40)])
    materialise(docs.limit(0))  # the checkpoint folder is set
    before = _tables(spark)
    grams, contexts = suffix_tree(docs.select("text"), DEPTH, DIVERGENCE)
    assert len(_tables(spark) - before) == 2
    assert grams.count() > 0 and contexts.count() > 0
