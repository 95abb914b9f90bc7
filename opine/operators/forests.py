"""Forests as data: a table of nodes, and scoring by walking it within the row.

A node has its tree, its number in the tree (0 is the root), the feature and the threshold that split it (values up to
the threshold go left), its children, and the shares of the classes among its training rows. A leaf has feature -1.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opine.session import new_folder

NODES = "tree int, node int, feature int, threshold double, left int, right int, shares array<double>"
DEEPEST = 30  # as deep as Spark grows a tree


def nodes_of(spark: SparkSession, model: RandomForestClassificationModel | PipelineModel) -> DataFrame:
    """The nodes of a fitted forest, or of the one in a pipeline, read from its saved form. Categories are not split on."""
    if isinstance(model, PipelineModel):
        model = next(s for s in model.stages if isinstance(s, RandomForestClassificationModel))
    path = new_folder(spark, "forest")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    stats = F.col("impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return saved.select(
        "tree",
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.transform(stats, lambda x: x / total).alias("shares"),
    )


def as_arrays(nodes: DataFrame) -> Column:
    """The whole forest as one value: an array of trees, each an array of nodes by number. Its size is the model's."""
    node = F.struct("node", "feature", "threshold", "left", "right", "shares")
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("trees")).scalar()


def class_shares(point: Column, trees: Column, depth: int = DEEPEST) -> Column:
    """The classes' shares of an array of numbers: the mean over the trees of the shares in the leaf it falls in."""

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree["nodes"], at)
            goes_left = F.get(point, node["feature"]).cast("double") <= node["threshold"]
            return F.when(node["feature"] < 0, at).when(goes_left, node["left"]).otherwise(node["right"])

        return F.get(tree["nodes"], F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step))["shares"]

    leaves = F.transform(trees, leaf)
    zeros = F.transform(F.get(leaves, F.lit(0)), lambda _: F.lit(0.0))
    sums = F.aggregate(leaves, zeros, lambda total, one: F.zip_with(total, one, lambda a, b: a + b))
    return F.transform(sums, lambda x: x / F.size(leaves))


def score(points: DataFrame, nodes: DataFrame, point: str = "point", depth: int = DEEPEST) -> DataFrame:
    """`points` with `shares`, one for each class."""
    held = points.withColumn("_trees", as_arrays(nodes))
    return held.withColumn("shares", class_shares(F.col(point), F.col("_trees"), depth)).drop("_trees")
