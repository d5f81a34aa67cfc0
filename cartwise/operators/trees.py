"""The fitted trees as a table of nodes, and what follows from it: scores and importances.

A saved model keeps a row per node; here they become a plain table that can be stored, compared and joined, and a
column expression that walks all trees over it. The expression gives the same probabilities as the model's own transform
(both are sums of leaf values in a sigmoid), so a score can be recomputed wherever the table is, without the model's classes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.session import intermediate_path

MOST_NODES = 2_000_000  # of all trees: the table becomes arrays that every task gets


def model_nodes(model: PipelineModel, feature_cols: list[str]) -> DataFrame:
    """``tree, weight, node, feature, threshold, left, right, value, gain, rows`` of every node of a boosted model.

    ``node`` 0 is a tree's root. An inner node sends a row to ``left`` when ``feature <= threshold``, else to ``right``; a leaf
    has no feature and gives its ``value``. ``rows`` is the weight of the training rows that reached it, ``gain`` what its split won.
    """
    spark = SparkSession.getActiveSession()
    path = intermediate_path(spark)
    model.stages[-1].write().overwrite().save(path)
    raw = spark.read.parquet(f"{path}/data")
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.stages[-1].treeWeights)], "tree int, weight double")
    names = F.array(*[F.lit(c) for c in feature_cols])
    n = F.col("nodeData") if "nodeData" in raw.columns else F.struct("*")
    nodes = raw.select(F.col("treeID").cast("int").alias("tree"), n.alias("n"))
    inner = F.col("n.split.featureIndex") >= 0
    return nodes.join(weights, "tree").select(
        "tree",
        "weight",
        F.col("n.id").alias("node"),
        F.when(inner, names[F.col("n.split.featureIndex")]).alias("feature"),
        F.when(inner, F.col("n.split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("n.leftChild")).alias("left"),
        F.when(inner, F.col("n.rightChild")).alias("right"),
        F.col("n.prediction").alias("value"),
        F.when(inner, F.col("n.gain")).alias("gain"),
        F.element_at("n.impurityStats", 1).alias("rows"),
    )


def node_importance(nodes: DataFrame) -> DataFrame:
    """``feature, importance``: every split's gain times the rows it split, summed per feature and scaled to sum to 1.

    Features that no tree splits on have no row.
    """
    won = nodes.where("feature is not null").groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("won"))
    total = won.select(F.sum("won")).scalar()
    return won.select("feature", (F.col("won") / total).alias("importance"))


def node_probability(nodes: DataFrame) -> Column:
    """The probability of the positive class as an expression over the feature columns.

    The nodes (bounded: ``MOST_NODES``) become arrays that go to the tasks; a batch of rows walks every tree from its root by index, as
    many steps as the deepest tree has levels, and the weighted leaf values go through the sigmoid of twice their sum.
    """
    rows = sorted(tuple(r) for r in nodes.select("tree", "node", "weight", "feature", "threshold", "left", "right", "value").limit(MOST_NODES + 1).collect())
    if len(rows) > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes")
    place = {(t, n): i for i, (t, n, *_) in enumerate(rows)}
    names = sorted({r[3] for r in rows if r[3] is not None})
    depth = _depth(rows)
    # a leaf leads to itself
    feature = np.array([names.index(r[3]) if r[3] is not None else 0 for r in rows], dtype=np.intp)
    threshold = np.array([r[4] if r[3] is not None else 0.0 for r in rows], dtype=float)
    left = np.array([place[r[0], r[5]] if r[3] is not None else i for i, r in enumerate(rows)], dtype=np.intp)
    right = np.array([place[r[0], r[6]] if r[3] is not None else i for i, r in enumerate(rows)], dtype=np.intp)
    share = np.array([r[2] * r[7] for r in rows], dtype=float)
    roots = [i for i, r in enumerate(rows) if r[1] == 0]

    @F.pandas_udf("double")
    def probability(given: pd.DataFrame) -> pd.Series:
        x = given.to_numpy(dtype=float)
        flat, first, total = x.reshape(-1), np.arange(len(x)) * x.shape[1], np.zeros(len(x))
        for root in roots:
            at = np.full(len(x), root)
            for _ in range(depth):
                # a null or NaN goes right
                at = np.where(flat.take(first + feature.take(at)) <= threshold.take(at), left.take(at), right.take(at))
            total += share.take(at)
        return pd.Series(1.0 / (1.0 + np.exp(-2.0 * total)))

    return probability(F.struct(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(names)] or [F.lit(0.0).alias("f0")]))


def _depth(rows: list[tuple]) -> int:
    """Steps from a root to the farthest leaf."""
    level = {(r[0], r[1]): 0 for r in rows if r[1] == 0}
    by = {(r[0], r[1]): r for r in rows}
    deepest, todo = 0, list(level)
    while todo:
        key = todo.pop()
        r = by[key]
        if r[3] is not None:
            for child in (r[5], r[6]):
                level[r[0], child] = level[key] + 1
                deepest = max(deepest, level[key] + 1)
                todo.append((r[0], child))
    return deepest
