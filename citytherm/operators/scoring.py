"""A fitted model as one row of a table, scored by expressions.

``model_row`` turns a linear model, tree, forest or booster into arrays: weights and
intercept, or the node table of all trees.  A table of such rows can be written,
joined and filtered like any other; ``predict`` takes the one that a selection leaves and
scores rows with built-in expressions, so no model object or Python worker is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.operators import trees

MODEL_SCHEMA = ("model string, intercept double, weights array<double>, roots array<int>, tree_weights array<double>, depth int, "
                "node_feature array<int>, node_threshold array<double>, node_left array<int>, node_right array<int>, node_value array<double>")


def linear_row(name: str, weights: Sequence[float], intercept: float) -> tuple:
    return (name, float(intercept), [float(w) for w in weights], *[None] * 8)


def tree_row(name: str, n: trees.Nodes) -> tuple:
    depth, level = 0, set(n.roots.tolist())
    while level := {c for i in level if n.feature[i] >= 0 for c in (int(n.left[i]), int(n.right[i]))}:
        depth += 1
    share = n.weights if n.boosted else [1.0 / len(n.roots)] * len(n.roots)
    return (name, 0.0, None, n.roots.tolist(), [float(w) for w in share], depth,
            n.feature.tolist(), n.threshold.tolist(), n.left.tolist(), n.right.tolist(), n.prediction.tolist())


def model_table(spark: SparkSession, models: dict) -> DataFrame:
    """One row for each fitted Spark model."""
    rows = [linear_row(name, m.coefficients, m.intercept) if hasattr(m, "coefficients") else tree_row(name, trees.nodes_of(spark, m))
            for name, m in models.items()]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def _linear(x: Sequence[Column]) -> Column:
    total = F.col("intercept")
    for i, c in enumerate(x):
        total = total + c * F.get("weights", F.lit(i))
    return total


def _trees(x: Sequence[Column]) -> Column:
    values = F.array(*x)

    def walk(root: Column) -> Column:
        # a leaf is its own child, so every row may take as many steps as the deepest tree
        return F.aggregate(F.sequence(F.lit(1), F.col("depth") + 1), root, lambda at, _: F.when(
            F.get("node_feature", at) < 0, at).when(F.get(values, F.get("node_feature", at)) <= F.get("node_threshold", at), F.get("node_left", at))
            .otherwise(F.get("node_right", at)))
    parts = F.zip_with("roots", "tree_weights", lambda r, w: w * F.get("node_value", walk(r)))
    return F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + p)


def predict(df: DataFrame, features: Sequence[str], model: DataFrame, out: str = "prediction",
            keep: Sequence[str] = ()) -> DataFrame:
    """``df`` with the prediction of the one model in ``model`` (and the model's columns of ``keep``).  Features are given
    in the model's order and scale; a null or NaN feature gives null."""
    x = [F.col(f).cast("double") for f in features]
    bad = F.lit(False)
    for c in x:
        bad = bad | c.isNull() | F.isnan(c)
    fields = [f.split()[0] for f in MODEL_SCHEMA.split(", ")]
    joined = df.crossJoin(F.broadcast(model.select(*fields).limit(1)))  # one row
    score = F.when(bad, None).when(F.col("weights").isNotNull(), _linear(x)).otherwise(_trees(x))
    return joined.withColumn(out, score).drop(*[f for f in fields if f not in keep])
