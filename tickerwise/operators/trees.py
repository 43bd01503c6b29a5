"""M3/M4 and E2 for tree ensembles as tables.

An ensemble is a node table: one row per (tree, node) with feature (0-based; NULL in a leaf), threshold, left and right child,
value (of the node's leaf, times the tree's weight).  A row goes left where its feature is at most the threshold; a missing
feature goes right, as a NaN does in the library's own trees.  The score of a row is the sum over trees of its leaf's value.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerwise.operators.attribution import MAX_BACKGROUND, background_rows
from tickerwise.schema import KEY, ORDER

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double"
MAX_NODES = 1_000_000  # what attribution holds in a task; scoring has no such bound

# ---- fixed values: the small ensemble scored by tree_scores / tree_shap (tree, node, feature name, threshold, left, right, value) ----
FIXED_TREES = [
    (0, 0, "returns", 0.1, 1, 2, None),
    (0, 1, "Close", -0.5, 3, 4, None),
    (0, 2, "volatility_20", 0.25, 5, 6, None),
    (0, 3, None, None, None, None, 0.30),
    (0, 4, None, None, None, None, 0.08),
    (0, 5, None, None, None, None, -0.12),
    (0, 6, None, None, None, None, -0.33),
    (1, 0, "ma_5", 0.0, 1, 2, None),
    (1, 1, "returns", -0.8, 3, 4, None),
    (1, 2, "Volume", 0.4, 5, 6, None),
    (1, 3, None, None, None, None, 0.21),
    (1, 4, "ma_20", 0.6, 7, 8, None),
    (1, 5, None, None, None, None, 0.05),
    (1, 6, None, None, None, None, -0.17),
    (1, 7, None, None, None, None, 0.11),
    (1, 8, None, None, None, None, -0.04),
    (2, 0, "Volume", -0.2, 1, 2, None),
    (2, 1, None, None, None, None, -0.06),
    (2, 2, "returns", 0.9, 3, 4, None),
    (2, 3, None, None, None, None, 0.09),
    (2, 4, None, None, None, None, -0.25),
]
# ---- end of fixed values ----


def fixed_ensemble(spark: SparkSession, features: list[str]) -> DataFrame:
    rows = [(t, n, None if f is None else features.index(f), h, le, r, v) for t, n, f, h, le, r, v in FIXED_TREES]
    return spark.createDataFrame(rows, NODES)


def node_table(model, path: str, spark: SparkSession) -> DataFrame:
    """The node table of a fitted ensemble, read from its own saved form under ``path`` (a fresh folder).

    The library saves one row per node with its split and children and one row per tree with its weight.
    """
    model.write().overwrite().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("_t", "_meta", "_w").select("_t", "_w")
    nodes = spark.read.parquet(f"{path}/data").join(weights, F.col("treeID") == F.col("_t"))
    inner = F.col("nodeData.leftChild") >= 0
    if nodes.where(inner & (F.col("nodeData.split.numCategories") >= 0)).limit(1).count():
        raise ValueError("the node table holds splits by threshold; this model splits by category")
    return nodes.select(F.col("treeID").cast("int").alias("tree"), F.col("nodeData.id").cast("int").alias("node"),
                        F.when(inner, F.col("nodeData.split.featureIndex")).cast("int").alias("feature"),
                        F.when(inner, F.col("nodeData.split.leftCategoriesOrThreshold")[0]).alias("threshold"),
                        F.when(inner, F.col("nodeData.leftChild")).cast("int").alias("left"),
                        F.when(inner, F.col("nodeData.rightChild")).cast("int").alias("right"),
                        F.when(~inner, F.col("nodeData.prediction") * F.col("_w")).alias("value"))


def descend(rows: DataFrame, nodes: DataFrame, features: list[str], row_key=(KEY, ORDER)) -> DataFrame:
    """M4 for trees: ``rows`` (one per ``row_key``) with the ensemble's ``score``, level by level.

    Each row starts at the root of every tree; a level is one equality join with the node table (a broadcast while the table is
    under the broadcast threshold, a shuffle beyond it).  The walk ends where every node is a leaf: as many levels as the deepest
    tree has, found from the node table alone.
    """
    levels, frontier = 0, nodes.where("node = 0").select("tree", "node")
    while True:  # the node table does not grow with the rows
        below = nodes.where("feature is not null").join(frontier, ["tree", "node"]).select("tree", F.explode(F.array("left", "right")).alias("node"))
        if below.isEmpty():
            break
        frontier, levels = below, levels + 1
    trees = [r["tree"] for r in nodes.where("node = 0").select("tree").distinct().orderBy("tree").collect()]  # numbers of the trees, no rows
    keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(row_key)]
    names = [f"_k{i}" for i in range(len(row_key))]
    table = nodes.select(F.col("tree").alias("_tree"), F.col("node").alias("_id"), F.col("feature").alias("_feature"), "threshold", "left", "right", "value")
    at = rows.select(*keys, F.array(*[F.col(f).cast("double") for f in features]).alias("_x"), F.explode(F.array(*map(F.lit, trees))).alias("_t"), F.lit(0).alias("_node"))
    for _ in range(levels):
        value = F.element_at("_x", F.col("_feature") + 1)
        step = F.when(F.col("_feature").isNull(), F.col("_node")).when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = (at.join(table.drop("value"), (F.col("_t") == F.col("_tree")) & (F.col("_node") == F.col("_id"))).select(*names, "_x", "_t", step.alias("_node")))
    leaves = at.join(table.select("_tree", "_id", "value"), (F.col("_t") == F.col("_tree")) & (F.col("_node") == F.col("_id")))
    scores = leaves.groupBy(*names).agg(F.sum("value").alias("score"))
    same = F.lit(True)
    for name, k in zip(names, row_key):
        same = same & F.col(k).eqNullSafe(F.col(name))
    return rows.join(scores, same).drop(*names)


def score_trees(rows: DataFrame, nodes: DataFrame, features: list[str], scale: float = 1.0, row_key=(KEY, ORDER)) -> DataFrame:
    """``rows`` with score, P(up) = 1 / (1 + exp(-scale * score)) and the class; the library's boosted classifier has ``scale`` 2."""
    out = descend(rows, nodes, features, row_key).withColumn("probability", 1.0 / (1.0 + F.exp(-F.lit(float(scale)) * F.col("score"))))
    return out.withColumn("prediction", (F.col("score") > 0).cast("int"))


# ------------------------------------------------------------- E2 for trees
def leaf_boxes(nodes: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """Every leaf as (features, lower, upper, value): a row is in the leaf where lower < x[features] <= upper for all of them."""
    by = {(r.tree, r.node): r for r in nodes.itertuples(index=False)}
    out, stack = [], [(t, 0, {}) for t in sorted(nodes["tree"].unique())]
    while stack:
        tree, node, box = stack.pop()
        r = by[tree, node]
        if pd.isna(r.feature):
            feats = sorted(box)
            out.append((np.array(feats, int), np.array([box[f][0] for f in feats]), np.array([box[f][1] for f in feats]), float(r.value)))
            continue
        f = int(r.feature)
        lo, hi = box.get(f, (-np.inf, np.inf))
        stack.append((tree, int(r.left), {**box, f: (lo, min(hi, r.threshold))}))
        stack.append((tree, int(r.right), {**box, f: (max(lo, r.threshold), hi)}))
    return out


def _inside(x: np.ndarray, feats, lo, hi) -> np.ndarray:
    """(rows, path features): which conditions of a leaf each row meets; a missing value meets those of the right side only."""
    v = x[:, feats]
    return np.where(np.isnan(v), np.isinf(hi), (v > lo) & (v <= hi))


def tree_contributions(x: np.ndarray, z: np.ndarray, leaves, width: int) -> np.ndarray:
    """(rows, features): Shapley values of the score against the background ``z``, exact.

    The score of a coalition (features of the row inside it, of the background row outside) reaches a leaf only if every condition is met by
    one of the two; features met by the row alone must be in (a of them), those met by the background row alone must be out (b of them).
    Over all subsets of the features the tree uses, that leaf adds v (a-1)! b! / (a+b)! to each of the first and takes
    v a! (b-1)! / (a+b)! from each of the second.
    """
    out = np.zeros((len(x), width))
    for feats, lo, hi, value in leaves:
        k = len(feats)
        if k == 0:
            continue
        mine, theirs = _inside(x, feats, lo, hi), _inside(z, feats, lo, hi)
        fact = np.array([factorial(i) for i in range(k + 1)], float)
        # rows of the same pattern share their sums over the background
        codes, row_of = np.unique(mine, axis=0, return_inverse=True)
        kinds, counts = np.unique(theirs, axis=0, return_counts=True)
        only_x, only_z = codes[:, None, :] & ~kinds[None], ~codes[:, None, :] & kinds[None]
        reached = (codes[:, None, :] | kinds[None]).all(axis=2)
        a, b = only_x.sum(axis=2), only_z.sum(axis=2)
        give = np.where(reached & (a > 0), fact[np.maximum(a - 1, 0)] * fact[b] / fact[a + b], 0.0) * counts
        take = np.where(reached & (b > 0), fact[a] * fact[np.maximum(b - 1, 0)] / fact[a + b], 0.0) * counts
        share = value * ((only_x * give[:, :, None]) - (only_z * take[:, :, None])).sum(axis=1) / len(z)
        np.add.at(out, (slice(None), feats), share[row_of.reshape(-1)])
    return out


def tree_shap(scaled: DataFrame, background: DataFrame, nodes: DataFrame, features: list[str], row_key=(KEY, ORDER),
              max_background: int = MAX_BACKGROUND) -> DataFrame:
    """E2(b) for a node table: (row_key..., feature, contribution, base_value, prediction) of the score, exact.

    Contributions and base value (the mean score of the background) add up to the row's score.  The background (at most
    ``max_background`` rows) and the node table (at most MAX_NODES rows, an error beyond) travel to the tasks.
    """
    spark = scaled.sparkSession
    z = background_rows(background, features, max_background)
    table = nodes.limit(MAX_NODES + 1).toPandas()
    if len(table) > MAX_NODES:
        raise ValueError(f"the ensemble has more than {MAX_NODES} nodes")
    sent = spark.sparkContext.broadcast((z, leaf_boxes(table)))
    schema = T.StructType([*(scaled.schema[k] for k in row_key), T.StructField("feature", T.StringType()), T.StructField("contribution", T.DoubleType()),
                           T.StructField("base_value", T.DoubleType()), T.StructField("prediction", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z, leaves = sent.value
        score = lambda m: sum((v * _inside(m, f, lo, hi).all(axis=1) for f, lo, hi, v in leaves), np.zeros(len(m)))
        base = float(score(z).mean())
        for pdf in batches:
            x = pdf[features].to_numpy(dtype=float)
            phi, n = tree_contributions(x, z, leaves, len(features)), len(features)
            yield pd.DataFrame({**{k: np.repeat(pdf[k].to_numpy(), n) for k in row_key}, "feature": np.tile(np.array(features, dtype=object), len(x)),
                                "contribution": phi.reshape(-1), "base_value": base, "prediction": np.repeat(score(x), n)})

    return scaled.select(*row_key, *features).mapInPandas(run, schema)
