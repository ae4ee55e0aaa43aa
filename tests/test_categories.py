"""Category index: frequency order, rare and unseen values, layouts; and fits side by side."""

import threading
import time

import pytest
from flowguard.config import ExperimentConfig
from flowguard.operators import categories, features, models
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

NAMES = ["a", "b"]


@pytest.mark.parametrize("ranks, chars", [(4096, 256), (2, 256), (4096, 1), (0, 0)])
def test_equals_the_string_indexer(spark, monkeypatch, ranks, chars):
    monkeypatch.setattr(categories, "LOOKUP_RANKS", ranks)
    monkeypatch.setattr(categories, "LOOKUP_CHARS", chars)
    df = spark.range(0, 500, 1, 7).selectExpr(
        "id", "concat('v', cast(sqrt(id) as int)) AS a", "if(id % 11 = 0, null, if(id % 13 = 0, double('nan'), id % 5 * 0.5)) AS b",
        "id % 3 AS value", "id % 2 AS `index`", "'x' AS `column`", "'long' AS count")
    out, index = features.index_categories(df, NAMES)
    indexer = StringIndexer(inputCols=NAMES, outputCols=["a_ref", "b_ref"], handleInvalid="keep").fit(df)
    got = indexer.transform(out)
    assert got.count() == 500 and got.filter("a_idx <> a_ref OR b_idx <> b_ref OR a_idx IS NULL OR b_idx IS NULL").count() == 0
    assert out.columns == [*df.columns, "a_idx", "b_idx"]
    unseen = index.transform(spark.createDataFrame([("v0", 9.75), (None, None), ("zz", 0.5)], "a string, b double"))
    ref = indexer.transform(unseen)
    assert ref.count() == 3 and ref.filter("a_idx <> a_ref OR b_idx <> b_ref").count() == 0
    index.release()


def test_ranks_do_not_depend_on_the_layout(spark):
    def ranks(parts):
        df = spark.range(0, 3000, 1, parts).selectExpr("concat('k', id) AS a", "id % 700 AS b")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            index = categories.fit_category_index(df, NAMES)
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        rows = sorted(map(tuple, index.table.collect()))
        index.release()
        return rows

    one = ranks(1)
    assert one == ranks(40)
    assert sorted(r[3] for r in one if r[0] == "a") == list(range(3000))
    expected = sorted(((-(3000 // 700 + (v < 3000 % 700)), str(v)) for v in range(700)))
    assert [r[1] for r in sorted((r for r in one if r[0] == "b"), key=lambda r: r[3])] == [v for _, v in expected]


def test_empty_table_and_taken_names(spark):
    empty = spark.createDataFrame([], "a string, b double")
    out, index = features.index_categories(empty, NAMES)
    assert out.count() == 0 and index.sizes == {"a": 0, "b": 0}
    with pytest.raises(ValueError, match="exist already"):
        index.transform(spark.createDataFrame([("x", 1.0, 0.0)], "a string, b double, a_idx double"))
    with pytest.raises(ValueError, match="no columns"):
        categories.fit_category_index(empty, [])


class Fit:
    def __init__(self, run):
        self.fit = run


def test_fits_run_side_by_side_in_order(spark, monkeypatch):
    meet = threading.Barrier(3)  # broken unless three fits are under way at once

    def classifier(name, cfg, n_classes=None):
        return Fit(lambda df: (meet.wait(timeout=60), df.count(), spark.sparkContext.getLocalProperty("spark.scheduler.pool")))

    monkeypatch.setattr(models, "build_classifier", classifier)
    fitted = models.train_models(spark.range(10), ["x", "y", "z"], ExperimentConfig(fit_threads=3))
    assert [(n, m[1:]) for n, m, _ in fitted] == [(n, (10, f"fit-{n}")) for n in "xyz"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None and not spark.sparkContext.getJobTags()


def test_first_failure_cancels_the_other_fits(spark, monkeypatch):
    started = threading.Event()
    slow = spark.range(0, 4000, 1, 2000).select(F.expr("reflect('java.lang.Thread', 'sleep', 200L)").alias("x"))

    def long_fit(df):
        started.set()
        for _ in range(50):  # many jobs, as an iterative fit has them
            slow.write.format("noop").mode("overwrite").save()

    def failing(df):
        assert started.wait(60)
        time.sleep(1)
        raise RuntimeError("no fit")

    monkeypatch.setattr(models, "build_classifier", lambda name, cfg, n_classes=None: Fit(failing if name == "bad" else long_fit))
    begin = time.time()
    with pytest.raises(RuntimeError, match="no fit"):
        models.train_models(spark.range(10), ["long", "bad"], ExperimentConfig(fit_threads=2))
    assert time.time() - begin < 60  # the jobs alone would take 50 times 100 s
    assert spark.range(100).count() == 100
