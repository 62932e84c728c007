"""Boosted trees as flat arrays that a column expression walks.

A node is a place in arrays of feature, threshold, children and value. The value of an input is the sum over
the trees of the leaf it reaches, each tree walked by a fold of its depth. So a whole forest is one expression,
usable inside the recursion of a forecast, and one row of a table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from panelcast.session import scratch_path


def _integers(values: Sequence[int]) -> Column:
    return F.expr(f"array({', '.join(map(str, values))})")


def _doubles(values: Sequence[float]) -> Column:
    return F.expr(f"array({', '.join(f'{v!r}D' for v in values)})")


@dataclass(frozen=True)
class Forest:
    """``feature`` is -1 at leaves, whose ``value`` includes the tree's weight; an input goes ``left`` where its
    feature is at most ``threshold``."""

    roots: tuple[int, ...]
    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]

    @property
    def depth(self) -> int:
        depth, level = 0, list(self.roots)
        while level := [c for n in level if self.feature[n] >= 0 for c in (self.left[n], self.right[n])]:
            depth += 1
        return depth

    def predict(self, inputs: Column) -> Column:
        """The forest's value of an array of inputs."""
        feature, left, right = (_integers(x) for x in (self.feature, self.left, self.right))
        threshold, value = _doubles(self.threshold), _doubles(self.value)
        levels = F.sequence(F.lit(1), F.lit(max(1, self.depth)))

        def down(x: Column):
            def step(node: Column, _: Column) -> Column:
                place = F.get(feature, node)
                child = F.when(F.get(x, place) <= F.get(threshold, node), F.get(left, node)).otherwise(F.get(right, node))
                return F.when(place < 0, node).otherwise(child)

            return step

        def total(x: Column) -> Column:
            return F.aggregate(_integers(self.roots), F.lit(0.0), lambda acc, root: acc + F.get(value, F.aggregate(levels, root, down(x))))

        # The inputs are computed once and not at every node.
        return F.transform(F.array(inputs), total)[0]


def flatten(spark: SparkSession, model) -> Forest:
    """A fitted ``pyspark.ml`` ensemble of regression trees, read from the node table it is saved as. The table has
    a row per node, at most trees times ``2 ** (depth + 1)``."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    split = "nodeData.split"
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.prediction").alias("value"),
        F.when(F.col("nodeData.leftChild") >= 0, F.col(f"{split}.featureIndex")).otherwise(-1).alias("feature"),
        F.coalesce(F.get(f"{split}.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("threshold"),
    )
    nodes = rows.orderBy("tree", "id").collect()
    place = {(r["tree"], r["id"]): i for i, r in enumerate(nodes)}
    weights = [float(w) for w in model.treeWeights]
    if not all(math.isfinite(r["threshold"]) for r in nodes):
        raise ValueError("a tree has a threshold that is no number")
    return Forest(
        roots=tuple(place[t, 0] for t in range(len(weights))),
        feature=tuple(r["feature"] for r in nodes),
        threshold=tuple(r["threshold"] for r in nodes),
        left=tuple(place.get((r["tree"], r["left"]), -1) for r in nodes),
        right=tuple(place.get((r["tree"], r["right"]), -1) for r in nodes),
        value=tuple(r["value"] * weights[r["tree"]] for r in nodes),
    )
