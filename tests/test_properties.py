"""Property tests: native votes vs numpy, metrics vs MLlib's evaluator, split invariants."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from flowguard.functions.exprs import hard_vote_expr, soft_vote_probability_expr, vector_argmax_expr
from flowguard.operators import metrics
from flowguard.operators.split import split_by_hash

SETTINGS = dict(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def np_hard(votes):
    valid = [int(v) for v in votes if v is not None]
    return None if not valid else float(np.argmax(np.bincount(valid)))


def np_soft(vecs):
    arrs = [np.array(v, dtype=float) for v in vecs if v is not None]
    if not arrs:
        return None
    width = max(len(a) for a in arrs)
    return np.mean([np.pad(a, (0, width - len(a))) for a in arrs], axis=0)


vote = st.one_of(st.none(), st.integers(0, 4).map(float))
vec = st.one_of(st.none(), st.lists(st.sampled_from([0.0, 0.125, 0.25, 0.5, 1.0]), min_size=1, max_size=5))


@settings(**SETTINGS)
@given(st.lists(st.tuples(vote, vote, vote), min_size=1, max_size=60))
def test_hard_vote_matches_numpy(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = [r[0] for r in df.select(hard_vote_expr([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert got == [np_hard(r) for r in rows]


@settings(**SETTINGS)
@given(st.lists(st.tuples(vec, vec, vec), min_size=1, max_size=40))
def test_soft_vote_matches_numpy(spark, rows):
    df = spark.createDataFrame(rows, "a array<double>, b array<double>, c array<double>")
    cols = [F.col("a"), F.col("b"), F.col("c")]
    for r, row in zip(rows, df.select(soft_vote_probability_expr(cols).alias("p")).collect()):
        want, got = np_soft(r), row["p"]
        if want is None:
            assert got is None
        else:
            assert np.allclose(got, want) and len(got) == len(want)


def test_argmax_first_max(spark):
    df = spark.createDataFrame([([0.1, 0.5, 0.5],), ([0.3],), (None,)], "p array<double>")
    assert [r[0] for r in df.select(vector_argmax_expr(F.col("p"))).collect()] == [1.0, 0.0, None]


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=8, max_size=80))
def test_metrics_match_mllib(spark, pairs):
    labels_seen = {l for _, l in pairs}
    pairs = [(p if p in labels_seen else min(labels_seen), l) for p, l in pairs]  # MLlib needs predicted ⊆ labels
    df = spark.createDataFrame([(float(p), float(l)) for p, l in pairs], "prediction double, label double")
    _, _, m = metrics.compute_metrics(df, "label", {"m": "prediction"})
    row = m.first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for ours, name in (("accuracy", "accuracy"), ("precision", "weightedPrecision"),
                       ("recall", "weightedRecall"), ("f1_weighted", "f1")):
        assert abs(row[ours] - ev.setMetricName(name).evaluate(df)) < 1e-9
    assert abs(row["recall"] - row["accuracy"]) < 1e-12


def test_hash_split_disjoint_and_complete(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    train, test = split_by_hash(df, ["k"], 0.8, 42)
    a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert not (a & b) and len(a | b) == 5000
    assert 0.75 < len(a) / 5000 < 0.85
    again, _ = split_by_hash(df.repartition(7), ["k"], 0.8, 42)
    assert {r[0] for r in again.collect()} == a  # independent of layout


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=8, max_size=80))
def test_per_class_match_mllib(spark, pairs):
    from pyspark.mllib.evaluation import MulticlassMetrics

    labels_seen = {l for _, l in pairs}
    pairs = [(p if p in labels_seen else min(labels_seen), l) for p, l in pairs]
    df = spark.createDataFrame([(float(p), float(l)) for p, l in pairs], "prediction double, label double")
    _, per, m = metrics.compute_metrics(df, "label", {"m": "prediction"})
    mm = MulticlassMetrics(spark.sparkContext.parallelize([(float(p), float(l)) for p, l in pairs]))
    for r in per.collect():
        k = r["label_idx"]
        assert abs(r["precision"] - mm.precision(k)) < 1e-12
        assert abs(r["recall"] - mm.recall(k)) < 1e-12
        assert abs(r["f1"] - mm.fMeasure(k, 1.0)) < 1e-12
    macro = sum(mm.fMeasure(float(k), 1.0) for k in labels_seen) / len(labels_seen)
    assert abs(m.first()["f1_macro"] - macro) < 1e-12
