"""Native evaluation of fitted models, and the slope of a logistic regression."""

import random

import numpy as np
import pytest
from flowguard.operators import certify
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = []
    for _ in range(600):
        x = [rng.gauss(0, 1), rng.gauss(5, 3), rng.randrange(4) * 1.0]
        data.append((Vectors.dense(x), float((x[0] + 0.3 * x[1] + rng.gauss(0, 1) > 1.5) + (x[2] > 2)), rng.random() + 0.5))
    return spark.createDataFrame(data, ["features", "label_idx", "weight"]).repartition(3).cache()


def test_trees_as_expressions(rows):
    forest = RandomForestClassifier(labelCol="label_idx", weightCol="weight", numTrees=7, seed=1).fit(rows)
    out = certify.forest_prediction(forest.transform(rows), forest, "own")
    assert out.filter("own <> prediction OR own IS NULL").count() == 0 and out.select("own").distinct().count() > 1
    two = rows.withColumn("label_idx", F.least("label_idx", F.lit(1.0)))
    boosted = GBTClassifier(labelCol="label_idx", maxIter=5, seed=1).fit(two)
    out = certify.boosted_prediction(boosted.transform(two), boosted, "own")
    assert out.filter("own <> prediction OR own IS NULL").count() == 0 and out.select("own").distinct().count() == 2
    nodes = certify.node_table(rows.sparkSession, forest)
    assert len(nodes) == 7
    for tree in nodes.values():  # a node's counts are those of its children
        for n in tree.values():
            if n["left"] >= 0:
                assert np.allclose(n["stats"], np.add(tree[n["left"]]["stats"], tree[n["right"]]["stats"]))


def test_slope_is_zero_at_the_optimum_only(rows):
    def slope(iterations):
        fitted = LogisticRegression(labelCol="label_idx", weightCol="weight", family="multinomial", regParam=0.01, maxIter=iterations, tol=1e-9).fit(rows)
        return abs(certify.logistic_gradient(rows, fitted, 0.01, "weight")).max(), fitted

    early, _ = slope(1)
    late, fitted = slope(200)
    assert early > 0.01 and late < 1e-5
    out = certify.with_logistic_probabilities(fitted.transform(rows), fitted, "own").select("own", "probability").collect()
    assert all(np.allclose(r["own"], r["probability"].toArray(), atol=1e-12) for r in out)
