"""A trained forest as a table of nodes, and its votes by joins, a level at a time."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators.optimality import FEATURES


def forest_nodes(spark: SparkSession, model, path: str) -> DataFrame:
    """One row per node of the forest, which is saved at ``path``: ``tree``, ``node``,
    ``feature`` and ``threshold`` (null at a leaf), ``left``, ``right``, and ``votes``, the
    share of each class among the training rows that came there.

    All features are numbers, so a split has one threshold.
    """
    model.write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    leaf = F.col("leftChild") < 0
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b)
    return saved.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(~leaf, F.col("leftChild")).alias("left"),
        F.when(~leaf, F.col("rightChild")).alias("right"),
        F.transform("impurityStats", lambda n: F.try_divide(n, total)).alias("votes"),
    )


def forest_votes(rows: DataFrame, nodes: DataFrame, key: str, *, depth: int) -> DataFrame:
    """``key``, ``votes`` (summed over the trees, by class) and ``prediction`` (the class
    with most votes, the first of equal ones) for every row.

    Each row starts at the root of every tree and goes down one level a join. The nodes
    are broadcast: there are at most 2^(depth + 1) for each tree, whatever the data. Only
    the last step shuffles, with votes combined first.
    """
    small = F.broadcast(nodes)
    trees = F.sequence(F.lit(0), F.lit(nodes.agg(F.max("tree")).first()[0]))
    walk = rows.select(key, vector_to_array(FEATURES).alias("x"), F.lit(0).alias("node"), F.explode(trees).alias("tree"))
    for _ in range(depth):
        step = walk.join(small.select("tree", "node", "feature", "threshold", "left", "right"), ["tree", "node"])
        down = F.when(F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        walk = step.select(key, "x", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(down).alias("node"))
    ends = walk.join(small.select("tree", "node", "votes"), ["tree", "node"])
    classes = len(nodes.first()["votes"])
    sums = ends.groupBy(key).agg(*[F.sum(F.col("votes")[k]).alias(f"votes_{k}") for k in range(classes)])
    votes = F.array(*[F.col(f"votes_{k}") for k in range(classes)])
    most = F.array_position(votes, F.array_max(votes)) - 1
    return sums.select(key, votes.alias("votes"), most.cast("double").alias("prediction"))
