"""Fitted forests as a table of nodes, and as one column expression."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from overspend.session import shared_dir


def node_table(spark: SparkSession, model: RandomForestRegressionModel) -> DataFrame:
    """One row per node: tree, node, feature, threshold, left and right child, value, training rows.

    Rows at or below the threshold go left. Leaves have no feature and no children. The rows are read from the model's own
    stored form. A split by category, which only features with named categories have, is refused.
    """
    folder = shared_dir(spark, "forest")
    model.write().save(folder)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    inner = node["leftChild"] >= 0
    refused = F.raise_error(F.lit("a split by category has no threshold")).cast("double")
    threshold = F.when(split["numCategories"] >= 0, refused).otherwise(F.get(split["leftCategoriesOrThreshold"], F.lit(0)))
    return spark.read.parquet(f"{folder}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner, threshold).alias("threshold"), F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"), node["prediction"].alias("value"), node["rawCount"].alias("rows"))


def forest_expression(nodes: DataFrame, features: str) -> Column:
    """The forest's prediction as one expression over a vector column.

    The nodes of all trees stand in flat arrays; the rows of a batch go down each tree together by looking up feature, threshold and children, as many
    steps as the tree has levels, and leaves stay where they are. The size of a model is bounded by its trees and depth, not by the data.
    Values are added in the order of the trees, as the model adds them, so both give the same number. A null vector gives null.
    """
    rows = nodes.orderBy("tree", "node").collect()
    place = {(r.tree, r.node): i for i, r in enumerate(rows)}
    down = {i: (place[r.tree, r.left], place[r.tree, r.right]) for i, r in enumerate(rows) if r.left is not None}
    roots = [place[tree, 0] for tree in sorted({r.tree for r in rows})]

    def depth(at: int) -> int:
        level, most = [at], 0
        while level := [child for node in level if node in down for child in down[node]]:
            most += 1
        return most

    feature = np.array([0 if r.feature is None else r.feature for r in rows])
    threshold = np.array([0.0 if r.threshold is None else r.threshold for r in rows])
    children = np.array([down.get(i, (i, i)) for i in range(len(rows))])[:, ::-1].ravel()
    value = np.array([r.value for r in rows])
    walks = [(root, depth(root)) for root in roots]

    def forest(x: np.ndarray) -> np.ndarray:
        flat, start, total = x.ravel(), np.arange(len(x)) * x.shape[1], np.zeros(len(x))
        for root, steps in walks:
            at = np.full(len(x), root)
            for _ in range(steps):
                at = children[2 * at + (flat[start + feature[at]] <= threshold[at])]
            total += value[at]
        return total / len(walks)

    @F.arrow_udf("double")
    def walked(vectors: pa.Array) -> pa.Array:
        known = vectors.is_valid().to_numpy(zero_copy_only=False)
        result = np.zeros(len(known))
        if known.any():
            result[known] = forest(vectors.flatten().to_numpy(zero_copy_only=False).reshape(known.sum(), -1))
        return pa.array(result, mask=~known)

    return walked(F.when(F.col(features).isNotNull(), vector_to_array(features)))
