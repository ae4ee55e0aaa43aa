"""Native evaluation of fitted models, to check what they predict.

Trees become a node table, and each tree a nested CASE over the feature columns; logistic
regression a softmax of literal coefficients. Both are plain column expressions. The
regularised gradient of a logistic regression takes one aggregation: near 0, the fit is the optimum.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.session import drop_path, scratch_path

#: Nodes of a forest that are compiled at most (the driver holds them).
MAX_NODES = 200_000


def node_table(spark: SparkSession, model) -> dict[int, dict[int, dict]]:
    """tree -> node id -> (feature, threshold, left, right, stats, prediction) of a fitted forest or boosted trees."""
    path = scratch_path(spark, "trees")
    model.save(path)
    data = spark.read.parquet(f"{path}/data")
    # a saved node table is (treeID, nodeData); its fields are the library's own
    rows = data.select("treeID", "nodeData.*").limit(MAX_NODES + 1).collect()
    drop_path(spark, path)
    if len(rows) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes")
    trees: dict[int, dict[int, dict]] = {}
    for r in rows:
        split = r["split"]
        if r["leftChild"] >= 0 and split["numCategories"] >= 0:
            raise ValueError("categorical splits aren't compiled")
        trees.setdefault(r["treeID"], {})[r["id"]] = {
            "feature": split["featureIndex"], "threshold": (split["leftCategoriesOrThreshold"] or [None])[0], "left": r["leftChild"],
            "right": r["rightChild"], "stats": list(r["impurityStats"]), "prediction": r["prediction"], "gain": r["gain"], "count": r["rawCount"]}
    return trees


def _walk(nodes: dict[int, dict], x: Column, leaf, at: int = 0) -> Column:
    n = nodes[at]
    if n["left"] < 0:
        return leaf(n)
    return F.when(F.get(x, F.lit(n["feature"])) <= F.lit(n["threshold"]), _walk(nodes, x, leaf, n["left"])).otherwise(_walk(nodes, x, leaf, n["right"]))


def _first_greatest(values: Column) -> Column:
    return (F.array_position(values, F.array_max(values)) - 1).cast("double")


def forest_prediction(df: DataFrame, model, output_col: str, features: str = "features") -> DataFrame:
    """The class of a random forest: the trees' leaves add their class shares; the first greatest sum wins."""
    trees = node_table(df.sparkSession, model)
    with_x = df.withColumn("__x", vector_to_array(F.col(features)))
    shares = lambda n: F.array(*[F.lit(s / sum(n["stats"])) for s in n["stats"]])
    votes = [f"__t{t}" for t in sorted(trees)]
    out = with_x.select("*", *[_walk(trees[t], F.col("__x"), shares).alias(v) for t, v in zip(sorted(trees), votes)])
    total = F.array(*[sum((F.get(F.col(v), F.lit(c)) for v in votes), F.lit(0.0)) for c in range(model.numClasses)])
    return out.withColumn(output_col, _first_greatest(total)).drop("__x", *votes)


def boosted_prediction(df: DataFrame, model, output_col: str, features: str = "features") -> DataFrame:
    """The class of boosted trees: 1 if the weighted sum of the leaves is above 0."""
    trees = node_table(df.sparkSession, model)
    names = [f"__t{t}" for t in sorted(trees)]
    out = df.withColumn("__x", vector_to_array(F.col(features)))
    out = out.select("*", *[_walk(trees[t], F.col("__x"), lambda n: F.lit(n["prediction"])).alias(v) for t, v in zip(sorted(trees), names)])
    margin = sum((F.lit(float(w)) * F.col(v) for w, v in zip(model.treeWeights, names)), F.lit(0.0))
    return out.withColumn(output_col, (margin > 0).cast("double")).drop("__x", *names)


def logistic_margins(model, x: Column) -> Column:
    """Literal coefficients times the array ``x``, plus the intercept, per class."""
    products = [F.zip_with(x, F.array(*[F.lit(float(v)) for v in row]), lambda a, b: a * b) for row in model.coefficientMatrix.toArray()]
    return F.array(*[F.aggregate(p, F.lit(float(b)), lambda s, v: s + v) for p, b in zip(products, model.interceptVector.toArray())])


def with_logistic_probabilities(df: DataFrame, model, output_col: str, features: str = "features") -> DataFrame:
    """``output_col``: the class probabilities (an array) of a multinomial logistic regression."""
    out = df.withColumn("__x", vector_to_array(F.col(features)))
    out = out.withColumn("__m", logistic_margins(model, F.col("__x")))
    out = out.withColumn("__m", F.transform("__m", lambda m: F.exp(m - F.array_max("__m"))))
    total = F.aggregate("__m", F.lit(0.0), lambda s, v: s + v)
    return out.withColumn("__s", total).withColumn(output_col, F.transform("__m", lambda m: m / F.col("__s"))).drop("__x", "__m", "__s")


def logistic_gradient(train: DataFrame, model, reg: float, weight_col: str | None = None, features: str = "features", label_col: str = "label_idx") -> np.ndarray:
    """classes x (features + intercept): the slope of the regularised mean loss at the fitted weights, by one aggregation.

    The penalty is on the coefficients of features scaled to deviation 1, as MLlib's is. The
    driver gets a row per class.
    """
    d, k = model.numFeatures, model.numClasses
    w = F.col(weight_col) if weight_col else F.lit(1.0)
    rows = with_logistic_probabilities(train.withColumn("__w", w.cast("double")), model, "__p", features)
    rows = rows.select("__w", vector_to_array(F.col(features)).alias("__x"), F.col(label_col).alias("__y"), F.posexplode("__p").alias("c", "p"))
    off = F.col("__w") * (F.col("p") - (F.col("__y") == F.col("c")).cast("double"))
    x = [F.get("__x", F.lit(j)) for j in range(d)]
    sums = rows.groupBy("c").agg(
        F.sum("__w").alias("w"), F.sum(F.col("__w") * F.col("__w")).alias("ww"), F.sum(off).alias("b"), *[F.sum(off * v).alias(f"g{j}") for j, v in enumerate(x)],
        *[F.sum(F.col("__w") * v).alias(f"m{j}") for j, v in enumerate(x)], *[F.sum(F.col("__w") * v * v).alias(f"q{j}") for j, v in enumerate(x)]).collect()
    out, coefficients = np.zeros((k, d + 1)), model.coefficientMatrix.toArray()
    for r in sums:
        mean, square = (np.array([r[f"{n}{j}"] for j in range(d)]) / r["w"] for n in "mq")
        variance = (square - mean**2) * r["w"] / (r["w"] - r["ww"] / r["w"])
        out[r["c"], :d] = np.array([r[f"g{j}"] for j in range(d)]) / r["w"] + reg * variance * coefficients[r["c"]]
        out[r["c"], d] = r["b"] / r["w"]
    return out
