"""Rejected lines, draws that don't depend on the layout, and scratch tables."""

from collections import Counter

import pytest
from flowguard.config import ExperimentConfig
from flowguard.operators import split
from flowguard.plans import experiment
from flowguard.session import checkpoint_dir, scratch_path
from flowguard.sources import flow_csv
from flowguard.sources.tables import lineitem_flows

SF = "/root/testdata/sf0.001"


def scratch(spark) -> set[str]:
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/flowguard-scratch")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(root)} if fs.exists(root) else set()


def test_rejects_are_parted_and_counted_in_the_pass_that_writes(spark):
    path = scratch_path(spark, "ragged") + "/r.csv"
    lines = [" A, B, Label", "1,2,x", "3", "4,5,y,6", "1,2,x", "7,8,"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    flows = experiment.prepare_flows(flow_csv.read_flow_csvs(spark, [path], rejects=True), ExperimentConfig(mode="multiclass", split="random", sample_fraction=1.0))
    assert flows.observed == {"accepted": 3, "rejected": 2}  # the line without a label is accepted, and incomplete
    assert sorted(map(tuple, flows.rejects.collect())) == [("r.csv", "3"), ("r.csv", "4,5,y,6")]
    assert [tuple(r)[:4] for r in flows.rows.select("A", "B", "label", "source_file").collect()] == [(1.0, 2.0, "x", "r.csv")] * 2
    assert flows.rows.select(split.DRAW).distinct().count() == 2  # equal rows have draws of their own
    flows.release()


def test_kdd_bad_line_is_treated_alike_by_every_read(spark):
    path = scratch_path(spark, "kdd-cells") + "/k"
    lines = [",".join(["1"] * (n - 1) + ["normal."]) for n in (42, 30, 42)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    for read in (lambda d: d.count(), lambda d: d.select("duration", "label").collect(), lambda d: d.select("duration").collect()):
        with pytest.raises(Exception, match="not 42 cells"):
            read(flow_csv.read_kdd(spark, path))
    tagged = flow_csv.read_kdd(spark, path, rejects=True)
    assert [r[1] for r in tagged.select("duration", flow_csv.RAGGED).collect()] == [None, lines[1], None]


def test_draws_do_not_depend_on_the_layout(spark, monkeypatch):
    rows = [(i % 7, None if i % 5 == 0 else "x" * (i % 3), 0.5 * (i % 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    parts = []
    for n, most in ((1, 100_000), (60, 100_000), (13, 7)):
        monkeypatch.setattr(split, "EQUAL_ROWS", most)
        train, test = split.split_random(df.repartition(n), 0.8, 42)
        parts.append((Counter(map(tuple, train.collect())), Counter(map(tuple, test.collect()))))
    assert parts[0] == parts[1] == parts[2]
    assert parts[0][0] + parts[0][1] == Counter(rows) and 2250 < sum(parts[0][0].values()) < 2550
    samples = [Counter(map(tuple, split.sample_fraction(df.repartition(n), 0.3, 42).collect())) for n in (1, 40)]
    assert samples[0] == samples[1] and 750 < sum(samples[0].values()) < 1050
    drawn = split.with_draw(df, 1)
    assert 650 < split.sample_fraction(drawn, 0.25, 2).count() < 850 and split.with_draw(df.limit(0)).count() == 0


def test_an_experiment_leaves_no_scratch_tables(spark, monkeypatch):
    flows = lineitem_flows(spark, SF).drop("l_orderkey", "l_linenumber")
    cfg = ExperimentConfig(mode="multiclass", split="random", sample_fraction=0.5, models=("nb",))
    before = scratch(spark)
    res = experiment.run_experiment(flows, cfg)
    again = experiment.run_experiment(flows.repartition(5), cfg)
    assert sorted(map(tuple, res.confusion.collect())) == sorted(map(tuple, again.confusion.collect()))
    for r in (res, again):
        r.release(results=True)
    assert scratch(spark) == before

    def fails(*args, **kw):
        raise RuntimeError("no fit")

    monkeypatch.setattr(experiment, "train_models", fails)
    with pytest.raises(RuntimeError, match="no fit"):
        experiment.run_experiment(flows, cfg)
    assert scratch(spark) == before
