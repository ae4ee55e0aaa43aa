"""Golden cases (FIXTURES.md sections 3 and 4): cleaning values, votes, metrics, weights."""

import math

import pytest
from pyspark.sql import functions as F

from flowguard.functions.exprs import clean_value, hard_vote_expr, sanitize_value, soft_vote_probability_expr
from flowguard.operators import clean, labels, metrics, weights
from flowguard.operators.ensemble import soft_vote
from flowguard.sources.flow_csv import unique_headers


def test_unique_headers():
    cells = [" Flow ID", "Fwd Header Length", "Fwd Header Length", " Label", "Fwd Header Length "]
    assert unique_headers(cells) == ["Flow ID", "Fwd Header Length", "Fwd Header Length_1", "Label", "Fwd Header Length_2"]
    assert unique_headers(["A", "A", "A_1"]) == ["A", "A_2", "A_1"]
    assert unique_headers(["A_1", "A", "A", "A"]) == ["A_1", "A", "A_2", "A_3"]


CLEAN_CASES = [
    ("12", 12.0), (" 12", 12.0), ("12 ", 12.0), ("-3.5", -3.5), ("1e5", 100000.0), ("1e999", math.inf),
    ("inf", 0.0), ("Infinity", 0.0), ("-Infinity", 0.0), ("NaN", 0.0), ("", 0.0), (None, 0.0), ("abc", 0.0),
    ("-", 0.0), ("+5", 0.0), (".5", 0.0), ("12abc", 0.0), ("12,5", 0.0), ("0x10", 0.0), ("1d", 1.0), ("1f", 1.0),
]


def test_clean_values(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CLEAN_CASES)], "i int, s string")
    got = dict(df.select("i", clean_value(F.col("s"), df.schema["s"].dataType).alias("d")).collect())
    for i, (raw, want) in enumerate(CLEAN_CASES):
        assert got[i] == want, (raw, got[i], want)


def test_clean_typed_numeric(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (None,), (-2.0,)], "x double")
    out = [r[0] for r in clean.clean_and_cast(df, skip=()).collect()]
    assert out == [1.5, 0.0, 0.0, 0.0, -2.0]


def test_sanitize(spark):
    df = spark.createDataFrame([(-3.5,), (float("inf"),), (float("-inf"),), (float("nan"),), (-0.0,), (2.0,)], "x double")
    out = [r[0] for r in df.select(sanitize_value(F.col("x"))).collect()]
    assert out == [0.0, 0.0, 0.0, 0.0, 0.0, 2.0]
    assert math.copysign(1.0, out[4]) == 1.0  # -0.0 normalised


@pytest.mark.parametrize("votes,want", [((1.0, 0.0), 0.0), ((2.0, 2.0, None), 2.0), ((None, None), None),
                                        ((3.0, 1.0, 1.0, 3.0), 1.0), ((4.0,), 4.0)])
def test_hard_vote(spark, votes, want):
    n = len(votes)
    df = spark.createDataFrame([votes], ", ".join(f"v{i} double" for i in range(n)))
    got = df.select(hard_vote_expr([F.col(f"v{i}") for i in range(n)]).alias("h")).first()["h"]
    assert got == want


def test_soft_vote_ragged(spark):
    df = spark.createDataFrame([([1.0], [0.2, 0.8])], "a array<double>, b array<double>")
    row = soft_vote(df, ["a", "b"], "pred", "prob").first()
    assert [round(x, 12) for x in row["prob"]] == [0.6, 0.4]
    assert row["pred"] == 0.0


def test_soft_vote_keeps_every_element(spark):
    df = spark.createDataFrame([([0.1, 0.2, 0.7], [0.2, 0.2, 0.6], None)], "a array<double>, b array<double>, c array<double>")
    row = soft_vote(df, ["a", "b", "c"], "pred", "prob").first()
    assert [round(x, 12) for x in row["prob"]] == [0.15, 0.2, 0.65] and row["pred"] == 2.0


def test_soft_vote_plan_is_linear_in_voters(spark):
    def size(voters):
        df = spark.createDataFrame([tuple([[0.5, 0.5]] * voters)], ", ".join(f"v{i} array<double>" for i in range(voters)))
        out = df.select(soft_vote_probability_expr([F.col(f"v{i}") for i in range(voters)]).alias("p"))
        return len(out._jdf.queryExecution().analyzed().toString())

    assert size(12) < 4 * size(4)


def test_soft_vote_all_null(spark):
    df = spark.createDataFrame([(None, None)], "a array<double>, b array<double>")
    got = df.select(soft_vote_probability_expr([F.col("a"), F.col("b")]).alias("p")).first()["p"]
    assert got is None


def test_metrics_golden(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 0.0), (1.0, 1.0), (0.0, 1.0)], "prediction double, label double")
    conf, per, m = metrics.compute_metrics(df, "label", {"m": "prediction"})
    pc = {r["label_idx"]: r for r in per.collect()}
    assert (pc[0.0]["precision"], pc[0.0]["recall"], pc[0.0]["f1"]) == (0.5, 0.5, 0.5)
    assert pc[1.0]["precision"] == 1.0 and pc[1.0]["recall"] == 0.5 and round(pc[1.0]["f1"], 4) == 0.6667
    assert (pc[2.0]["precision"], pc[2.0]["recall"], pc[2.0]["f1"], pc[2.0]["support"]) == (0.0, 0.0, 0.0, 0)
    row = m.first()
    assert row["accuracy"] == 0.5 and row["precision"] == 0.75
    assert round(row["f1_weighted"], 4) == 0.5833 and round(row["f1_macro"], 4) == 0.3889
    assert row["recall"] == row["accuracy"]


def test_never_predicted_class(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0)], "prediction double, label double")
    _, per, _ = metrics.compute_metrics(df, "label", {"m": "prediction"})
    pc = {r["label_idx"]: r for r in per.collect()}
    assert (pc[1.0]["precision"], pc[1.0]["recall"], pc[1.0]["f1"]) == (0.0, 0.0, 0.0)


def test_abstaining_voter_counts_as_wrong(spark):
    df = spark.createDataFrame([(None, 0.0), (0.0, 0.0)], "prediction double, label double")
    _, _, m = metrics.compute_metrics(df, "label", {"m": "prediction"})
    assert m.first()["accuracy"] == 0.5


def test_class_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 6 + [(1.0,)] * 2, "label_idx double")
    w = {r["label_idx"]: r["weight"] for r in weights.class_weights(df).collect()}
    assert w == {0.0: 8 / (2 * 6), 1.0: 8 / (2 * 2)}
    out = weights.add_class_weights(df)
    assert round(out.agg(F.sum("weight")).first()[0], 9) == 8.0  # sum of weights = row count
    table = weights.class_weights(df).filter(F.col("label_idx") == 0.0)
    unseen = weights.add_class_weights(df, weights=table).filter(F.col("label_idx") == 1.0).first()["weight"]
    assert unseen == 1.0


def test_labels(spark):
    df = spark.createDataFrame([(" BENIGN ",), ("DDoS",), ("benign",), (None,)], "label string")
    assert [r[0] for r in labels.prepare_labels(df, "binary", "BENIGN").collect()] == ["normal", "attack", "normal", "attack"]
    assert [r[0] for r in labels.prepare_labels(df, "multiclass").collect()] == ["BENIGN", "DDoS", "benign", None]
    dotted = spark.createDataFrame([("normal.",), ("smurf",)], "label string")
    assert [r[0] for r in clean.strip_label_dot(dotted).collect()] == ["normal", "smurf"]


def test_normalize_label_column(spark):
    df = spark.createDataFrame([(1, "x")], "a int, ` Label` string")
    assert clean.normalize_label_column(df).columns == ["a", "label"]
    with pytest.raises(ValueError):
        clean.normalize_label_column(spark.createDataFrame([(1,)], "a int"))


def test_label_counts_match_string_indexer_and_weights(spark):
    from flowguard.operators.features import fit_label_indexer, label_counts
    from flowguard.operators.weights import add_weights_from_counts, weights_from_counts

    rows = [("b",)] * 3 + [("a",)] * 3 + [("c",)] * 5 + [("d",)]
    df = spark.createDataFrame(rows, "label string")
    counts = label_counts(df)
    assert [lbl for lbl, _ in counts] == list(fit_label_indexer(df).labels) == ["c", "a", "b", "d"]
    indexed = fit_label_indexer(df).transform(df)
    by_join = {r["label_idx"]: r["weight"] for r in weights.add_class_weights(indexed).collect()}
    by_map = {r["label_idx"]: r["weight"] for r in add_weights_from_counts(indexed, counts).collect()}
    assert by_join == by_map == weights_from_counts(counts)


def test_sanitize_stage_drops_null_nan_rows(spark):
    from pyspark.ml.functions import vector_to_array

    from flowguard.operators.features import feature_pipeline

    rows = [("a", 1.0, 2.0), ("a", None, 1.0), ("b", float("nan"), 1.0), ("b", float("inf"), -3.0),
            ("a", -0.0, float("-inf"))]
    df = spark.createDataFrame(rows, "label string, x double, y double")
    out = feature_pipeline(["x", "y"]).fit(df).transform(df)
    got = sorted(tuple(r) for r in out.select(vector_to_array("features")).collect())
    assert got == [([0.0, 0.0],), ([0.0, 0.0],), ([1.0, 2.0],)]
