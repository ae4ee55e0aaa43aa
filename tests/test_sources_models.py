"""CSV sources, profile resolution, model selection and experiment invariants."""

import pathlib

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from conftest import SF_SMALL
from flowguard import session
from flowguard.config import ExperimentConfig
from flowguard.operators.ensemble import soft_vote
from flowguard.operators.models import build_classifier, select_models
from flowguard.plans.experiment import run_experiment
from flowguard.session import checkpoint_dir, scratch_path
from flowguard.sources import flow_csv
from flowguard.sources.tables import lineitem_flows


def test_scratch_below_checkpoint_dir(spark):
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark))


def test_read_flow_csv_headers_and_header_rows(spark):
    rows = [("1", "2.5", "BENIGN"), (" 3", "inf", " DDoS"), ("x", "7", "BENIGN")]
    df = spark.createDataFrame(rows, "a string, b string, c string").repartition(3)
    path = scratch_path(spark, "t") + "/Tuesday.csv"
    flow_csv.write_flow_csv(df, path, [" Flow Bytes/s", "Flow Bytes/s", " Label"])
    raw = flow_csv.read_flow_csv(spark, path)
    assert raw.columns == ["Flow Bytes/s", "Flow Bytes/s_1", "Label", "source_file"]
    assert raw.count() == 3  # one header line per part file, all dropped
    assert {r["source_file"] for r in raw.collect()} == {"Tuesday.csv"}
    cleaned = flow_csv.read_flow_csvs(spark, [path])
    got = sorted((r["Flow Bytes/s"], r["Flow Bytes/s_1"], r["label"]) for r in cleaned.collect())
    assert got == [(0.0, 7.0, "BENIGN"), (1.0, 2.5, "BENIGN"), (3.0, 0.0, " DDoS")]


def test_read_flow_csvs_requires_paths(spark):
    with pytest.raises(FileNotFoundError):
        flow_csv.read_flow_csvs(spark, [])


def test_resolve_profile_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        flow_csv.resolve_profile(spark, str(tmp_path), "small")
    with pytest.raises(ValueError):
        flow_csv.resolve_profile(spark, str(tmp_path), "huge")
    with pytest.raises(ValueError):
        flow_csv.resolve_profile(spark, str(tmp_path), "small", dataset="other")


def test_select_models():
    assert select_models(ExperimentConfig(fast=True))[0] == ["naive_bayes", "random_forest"]
    names, skipped = select_models(ExperimentConfig(), n_classes=3)
    assert names == ["naive_bayes", "logistic_regression", "random_forest"] and "gradient_boosted_trees" in skipped
    assert select_models(ExperimentConfig(models=("rf", "nb")))[0] == ["naive_bayes", "random_forest"]
    with pytest.raises(ValueError):
        select_models(ExperimentConfig(models=("svm",)))
    with pytest.raises(ValueError, match="svm"):
        select_models(ExperimentConfig(models=("nb", "svm")))
    with pytest.raises(ValueError, match="3 classes"):
        select_models(ExperimentConfig(models=("gbt",)), n_classes=3)
    assert select_models(ExperimentConfig(models=("gbt",), gbt_one_vs_rest=True), n_classes=3)[0] == ["gradient_boosted_trees"]


def test_weight_column_only_when_used():
    rf = build_classifier("random_forest", ExperimentConfig(class_weights=False))
    assert not rf.isSet("weightCol")
    lr = build_classifier("logistic_regression", ExperimentConfig(class_weights=True))
    assert lr.getWeightCol() == "weight"
    nb = build_classifier("naive_bayes", ExperimentConfig(class_weights=True))
    assert not nb.isSet("weightCol")


def test_run_experiment_end_to_end(spark):
    days = [f"day-{y}.csv" for y in range(1995, 2002)]
    cfg = ExperimentConfig(mode="binary", normal_label="N", split="file", sample_fraction=1.0,
                           train_sources=tuple(days[:5]), test_sources=tuple(days[5:]), fast=True)
    flows = lineitem_flows(spark, SF_SMALL).drop("l_orderkey", "l_linenumber")
    res = run_experiment(flows, cfg)
    cmp = {r["model"]: r for r in res.comparison.collect()}
    assert set(cmp) == {"naive_bayes", "random_forest", "ensemble_hard_vote", "ensemble_soft_vote"}
    assert all(0.0 <= r["accuracy"] <= 1.0 for r in cmp.values())
    assert cmp["naive_bayes"]["train_time_sec"] > 0 and cmp["ensemble_hard_vote"]["train_time_sec"] is None
    # every test row is counted once per model
    totals = {r["model"]: r["n"] for r in res.confusion.groupBy("model").agg(F.sum("count").alias("n")).collect()}
    assert len(set(totals.values())) == 1
    assert res.best_overall in cmp and res.best_single in ("naive_bayes", "random_forest")
    res.release()


def test_cic_profile_end_to_end(spark):
    """Capture days named as in the 'small' profile: resolve, load (one scan), file-split experiment."""
    li = lineitem_flows(spark, SF_SMALL)
    base = scratch_path(spark, "cic")
    header = [" Flow Duration", "Fwd Header Length", "Fwd Header Length", " Label"]
    train_name, test_name = flow_csv.CICIDS_PROFILES["small"][0][0], flow_csv.CICIDS_PROFILES["small"][1][0]
    label = F.when(F.col("label") == "N", "BENIGN").otherwise("DDoS")
    for name, cond in ((train_name, F.col("source_file") < "day-2000.csv"), (test_name, F.col("source_file") >= "day-2000.csv")):
        day = li.filter(cond).select("l_quantity", "l_discount", "l_tax", label.alias("label"))
        flow_csv.write_flow_csv(day, f"{base}/{name}", header)
    assert flow_csv.split_paths(spark, base, "small", "test") == [f"{base}/{test_name}"]
    flows = flow_csv.load_dataset(spark, base, "cicids", "small")
    assert flows.columns == ["Flow Duration", "Fwd Header Length", "Fwd Header Length_1", "label", "source_file"]
    assert flows.count() == li.count()
    cfg = ExperimentConfig(split="file", sample_fraction=1.0, fast=True, train_sources=(train_name,),
                           test_sources=(test_name,))
    res = run_experiment(flows, cfg)
    assert res.labels == ["normal", "attack"] or res.labels == ["attack", "normal"]
    assert {r["model"] for r in res.comparison.collect()} >= {"naive_bayes", "random_forest"}
    res.release()


def test_categorical_metadata_and_max_bins(spark):
    """Q25: nominal category indices need maxBins >= categories; the default drops the metadata."""
    from flowguard.operators import features

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        F.concat(F.lit("svc"), (F.col("l_partkey") % 41).cast("string")).alias("service"),
        "l_quantity", F.col("l_returnflag").alias("label"))
    n_cats = li.select("service").distinct().count()
    assert n_cats > 32
    for keep, bins, ok in ((False, 32, True), (True, 32, False), (True, n_cats + 1, True)):
        cfg = ExperimentConfig(class_weights=False, rf_trees=2, max_bins=bins)
        prep = features.feature_pipeline(["service", "l_quantity"], ["service"], keep_categorical_metadata=keep).fit(li)
        data = prep.transform(li).select("label_idx", "features")
        try:
            build_classifier("random_forest", cfg).fit(data)
            fitted = True
        except Exception:  # noqa: BLE001 - MLlib raises IllegalArgumentException through py4j
            fitted = False
        assert fitted == ok, (keep, bins)


def test_config_from_env():
    cfg = ExperimentConfig.from_env({"NIDS_MODE": "MULTICLASS", "NIDS_DATASET": "kdd", "NIDS_MODELS": "rf, nb",
                                     "NIDS_FAST": "yes", "NIDS_SAMPLE_FRACTION": "0.1"})
    assert (cfg.mode, cfg.dataset, cfg.models, cfg.fast, cfg.sample_fraction) == ("multiclass", "kdd", ("rf", "nb"), True, 0.1)
    assert cfg.normal_label == "normal"
    with pytest.raises(ValueError):
        ExperimentConfig(mode="ternary")


def test_run_and_export(spark):
    """Raw capture days -> experiment -> every result table written and readable."""
    from flowguard.plans.run import run_and_export
    from flowguard.sinks import writers

    li = lineitem_flows(spark, SF_SMALL)
    base = scratch_path(spark, "cic-run")
    header = [" Flow Duration", "Fwd Header Length", "Fwd Header Length", " Label"]
    train_name, test_name = flow_csv.CICIDS_PROFILES["small"][0][0], flow_csv.CICIDS_PROFILES["small"][1][0]
    label = F.when(F.col("label") == "N", "BENIGN").otherwise("DDoS")
    for name, cond in ((train_name, F.col("source_file") < "day-2000.csv"), (test_name, F.col("source_file") >= "day-2000.csv")):
        day = li.filter(cond).select("l_quantity", "l_discount", "l_tax", label.alias("label"))
        flow_csv.write_flow_csv(day, f"{base}/{name}", header)
    out = scratch_path(spark, "cic-out")
    cfg = ExperimentConfig(data_size="small", sample_fraction=1.0, fast=True)
    written = run_and_export(spark, base, out, cfg, both_splits=True)
    assert set(written) == {"random", "file"}
    for paths in written.values():
        assert {"label_distribution", "model_comparison", "per_class_metrics", "confusion_matrix",
                "experiment_results", "report/table5_ranking", "charts/class_f1_heatmap"} <= set(paths)
        cmp = spark.read.schema(writers.COMPARISON_SCHEMA).option("header", True).csv(paths["model_comparison"])
        assert {r["model"] for r in cmp.collect()} == {"naive_bayes", "random_forest", "ensemble_hard_vote",
                                                         "ensemble_soft_vote"}
        dist = spark.read.schema(writers.LABEL_DIST_SCHEMA).option("header", True).csv(paths["label_distribution"])
        assert sum(r["count"] for r in dist.collect()) == li.count()


def test_header_column_count_mismatch(spark):
    path = scratch_path(spark, "badhdr") + "/bad.csv"
    spark.createDataFrame([('a,"b,c"',), ("1,2",)], "value string").coalesce(1).write.text(path)
    names = flow_csv.read_header(spark, path)  # quoted comma: both parsers agree on 2 columns
    assert names == ["a", "b,c"]
    path2 = scratch_path(spark, "badhdr") + "/bad2.csv"
    # Python's csv sees 3 fields; Spark's parser (backslash escapes) sees 2 -> refuse the file.
    spark.createDataFrame([('a,"b\\",c"',), ("1,2",)], "value string").coalesce(1).write.text(path2)
    with pytest.raises(ValueError, match="mismatch"):
        flow_csv.read_header(spark, path2)


def test_gbt_one_vs_rest_multiclass(spark):
    """Q3: multiclass GBT runs one-vs-rest when asked; soft vote uses the models with probabilities."""
    days = [f"day-{y}.csv" for y in range(1995, 2002)]
    base = dict(mode="multiclass", split="file", sample_fraction=1.0, train_sources=tuple(days[:5]),
                test_sources=tuple(days[5:]), models=("nb", "lr", "gbt"), gbt_iter=3, lr_iter=5)
    flows = lineitem_flows(spark, SF_SMALL).drop("l_orderkey", "l_linenumber")
    with pytest.raises(ValueError, match="3 classes"):
        run_experiment(flows, ExperimentConfig(**base))
    res = run_experiment(flows, ExperimentConfig(**(base | {"models": (), "rf_trees": 2})))
    assert "gradient_boosted_trees" in res.skipped
    res.release()
    res = run_experiment(flows, ExperimentConfig(**base, gbt_one_vs_rest=True))
    models = {r["model"] for r in res.comparison.collect()}
    assert models == {"naive_bayes", "logistic_regression", "gradient_boosted_trees", "ensemble_hard_vote",
                      "ensemble_soft_vote"}
    res.release()


def test_cli(spark, capsys):
    """The runner's flags: validation, missing files -> exit 1, a full run -> result paths."""
    from flowguard import cli

    with pytest.raises(SystemExit):
        cli.parse_args(["--data-dir", "x", "--output-dir", "y", "--sample", "0.01"])
    missing = scratch_path(spark, "nothing-here")
    assert cli.main(["--data-dir", missing, "--output-dir", scratch_path(spark, "o"), "--size", "small"], spark) == 1

    li = lineitem_flows(spark, SF_SMALL)
    base = scratch_path(spark, "cli-data")
    (train_name,), (test_name,) = flow_csv.CICIDS_PROFILES["small"]
    for name, cond in ((train_name, F.col("source_file") < "day-2000.csv"), (test_name, F.col("source_file") >= "day-2000.csv")):
        flow_csv.write_flow_csv(li.filter(cond).select("l_quantity", "l_tax", "label"), f"{base}/{name}",
                                [" Flow Duration", "Fwd Packets", " Label"])
    out = scratch_path(spark, "cli-out")
    code = cli.main(["--data-dir", base, "--output-dir", out, "--size", "small", "--split", "file", "--sample", "1.0",
                     "--mode", "multiclass", "--models", "nb,rf"], spark)
    assert code == 0
    assert '"model_comparison"' in capsys.readouterr().out


def test_source_tags_do_not_depend_on_company(spark):
    """A file's tag is its name on disk, read alone or with others; file splits by it lose nothing."""
    base = scratch_path(spark, "odd names")
    names = ["Fri day.csv", "a=b.csv", "x+y%20z.csv"]
    for i, name in enumerate(names):
        fs, p = flow_csv._file_system(spark, f"{base}/{name}")
        out = fs.create(p)
        out.write(bytearray(f" A, Label\n{i},BENIGN\n,DDoS\n".encode()))
        out.close()
    paths = [f"{base}/{n}" for n in names]
    alone = {n: {r["source_file"] for r in flow_csv.read_flow_csv(spark, p).collect()} for n, p in zip(names, paths)}
    together = {r["source_file"] for r in flow_csv.read_flow_csvs(spark, paths).collect()}
    assert alone == {n: {n} for n in names} and together == set(names)
    assert flow_csv.read_flow_csvs(spark, paths).count() == 6  # rows with a blank first cell stay
    assert [flow_csv.source_basename(p) for p in paths] == names and flow_csv.source_basename("x/day=a.csv", folder=True) == "a.csv"


def test_listed_source_without_rows(spark):
    flows = lineitem_flows(spark, SF_SMALL).drop("l_orderkey", "l_linenumber")
    cfg = ExperimentConfig(mode="binary", normal_label="N", fast=True, train_sources=("day-1996.csv",), test_sources=("day-2050.csv",))
    with pytest.raises(ValueError, match="day-2050"):
        run_experiment(flows, cfg)


def test_ragged_rows(spark):
    path = scratch_path(spark, "ragged") + "/r.csv"
    spark.createDataFrame([(" A, B, Label",), ("1,2,x",), ("3",), ("4,5,y,6",)], "value string").coalesce(1).write.text(path)
    assert [tuple(r) for r in flow_csv.read_flow_csvs(spark, [path]).collect()] == [(1.0, 2.0, "x", "r.csv")]
    assert sorted(r["record"] for r in flow_csv.ragged_rows(spark, [path]).collect()) == ["3", "4,5,y,6"]


def test_kdd_column_count(spark):
    def file(*sizes):
        path = scratch_path(spark, "kdd-cells") + "/k"
        spark.createDataFrame([(",".join(["1"] * (n - 1) + ["normal."]),) for n in sizes], "value string").coalesce(1).write.text(path)
        return path

    assert flow_csv.read_kdd(spark, file(42, 42)).count() == 2
    with pytest.raises(ValueError, match="40 columns"):
        flow_csv.read_kdd(spark, file(40, 42))
    with pytest.raises(Exception, match="not 42 cells"):
        flow_csv.read_kdd(spark, file(42, 45)).collect()


def test_kdd_through_the_cli(spark, capsys):
    """Categorical columns come with the dataset, and both splits become one random split, once and with a warning."""
    from flowguard import cli
    from flowguard.checks.q_sources import kdd_frame

    base, out = scratch_path(spark, "kdd-cli"), scratch_path(spark, "kdd-out")
    flow_csv.write_kdd_csv(kdd_frame(spark, SF_SMALL), f"{base}/{flow_csv.KDD_FILENAME}")
    with pytest.warns(UserWarning, match="random split"):
        code = cli.main(["--data-dir", base, "--output-dir", out, "--dataset", "kdd", "--models", "nb", "--sample", "1.0"], spark)
    said = capsys.readouterr().out
    assert code == 0 and '"random"' in said and '"file"' not in said


def test_hash_split_from_the_cli():
    from flowguard import cli

    with pytest.raises(SystemExit):
        cli.parse_args(["--data-dir", "x", "--output-dir", "y", "--split", "hash"])
    args = cli.parse_args(["--data-dir", "x", "--output-dir", "y", "--split", "hash", "--keys", "a, b"])
    assert cli.config_from_args(args).key_cols == ("a", "b")


def test_shared_folder_is_asked_for_off_local_masters(monkeypatch):
    from types import SimpleNamespace

    conf = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))


def test_raw_flows_are_read_once(spark):
    """Both splits and every result table read the prepared table: one CSV scan in all."""
    from flowguard.plans.experiment import prepare_flows, run_both_splits
    from flowguard.sources.flow_csv import read_flow_csvs

    li = lineitem_flows(spark, SF_SMALL)
    base = scratch_path(spark, "once")
    names = ("a.csv", "b.csv")
    for name, cond in zip(names, (F.col("source_file") < "day-2000.csv", F.col("source_file") >= "day-2000.csv")):
        flow_csv.write_flow_csv(li.filter(cond).select("l_quantity", "l_tax", "label"), f"{base}/{name}", [" D", " P", " Label"])
    cfg = ExperimentConfig(mode="binary", normal_label="N", models=("nb",), train_sources=names[:1], test_sources=names[1:])
    flows = prepare_flows(read_flow_csvs(spark, [f"{base}/{n}" for n in names]), cfg)
    fs, p = flow_csv._file_system(spark, base)
    fs.delete(p, True)  # nothing may read the captures again
    for res in run_both_splits(flows, cfg).values():
        assert res.comparison.count() == 1 and res.label_counts.count() == 2
        res.release()
    flows.release()


def test_source_tag_looks_for_no_pattern_in_every_row(spark, tmp_path):
    """The folder's name is cut from the path by position; odd names come back as they are on disk."""
    names = ["Monday-flows.csv", "day=a b+c%.csv", "k=x=y.csv"]
    for name in names:
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.csv").write_text("A,Label\n1,x\n")
    read = flow_csv.read_flow_csvs(spark, [str(tmp_path / name) for name in names])
    assert sorted(r.source_file for r in read.collect()) == ["Monday-flows.csv", "a b+c%.csv", "x=y.csv"]
    one = flow_csv.read_flow_csv(spark, str(tmp_path / names[0]))
    assert [tuple(r) for r in one.collect()] == [("1", "x", "Monday-flows.csv")]
    assert "regexp" not in one._jdf.queryExecution().optimizedPlan().toString()


def test_kdd_scratch_is_written_compressed(spark, tmp_path):
    from flowguard.checks.q_sources import kdd_frame, write_kdd_file

    plain, packed = str(tmp_path / "plain"), write_kdd_file(spark, SF_SMALL)
    size = lambda p: sum(f.stat().st_size for f in pathlib.Path(p).glob("part-*"))
    flow_csv.write_kdd_csv(kdd_frame(spark, SF_SMALL), plain)
    assert size(packed.removeprefix("file:")) * 3 < size(plain)
    a, b = flow_csv.read_kdd(spark, plain), flow_csv.read_kdd(spark, packed)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 < a.count()
    flow_csv.write_kdd_csv(kdd_frame(spark, SF_SMALL), str(tmp_path / "many"), compression="gzip", file_rows=500)
    many = spark.read.text(str(tmp_path / "many")).groupBy("_metadata.file_name").count().collect()
    assert max(r["count"] for r in many) <= 500 and sum(r["count"] for r in many) == a.count()


def test_training_frames_are_dealt_by_cells(spark, monkeypatch):
    from flowguard.operators.features import assemble_features

    monkeypatch.setattr(session, "TASK_CELLS", 1200)
    rows = spark.range(1000, numPartitions=1).withColumn("x", F.lit(1.0))
    for frame, most in ((rows, 120), (assemble_features(rows, ["id", "x"]).select("id", "features"), 110)):
        df = session.materialize(frame)
        held = df.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in held) <= most * 1.1 and sum(r["count"] for r in held) == 1000
        assert df.agg(F.count_distinct("id")).first()[0] == 1000
        files = df.inputFiles()
        session.drop_table(df)
        assert not any(pathlib.Path(f.removeprefix("file://")).exists() for f in files)


def test_training_frames_keep_all_cores_busy(spark, monkeypatch):
    """A frame of few file splits goes to every core, a split more than the cores have makes no second wave."""
    slots = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(session, "MIN_TASK_CELLS", 900, raising=False)  # 100 rows of 9 cells
    for files in (1, slots + 1):
        df = session.materialize(spark.range(200 * slots, numPartitions=files))
        held = df.groupBy(F.spark_partition_id()).count().collect()
        assert len(held) == df.rdd.getNumPartitions() == slots
        assert max(r["count"] for r in held) <= 1.2 * 200 and df.agg(F.count_distinct("id")).first()[0] == 200 * slots
        session.drop_table(df)
    skewed = spark.range(200 * slots).repartitionByRange(slots, F.when(F.col("id") < 100 * slots, 0).otherwise(F.col("id")))
    df = session.materialize(skewed)  # a split with half of the rows
    assert max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()) <= 1.2 * 200
    session.drop_table(df)
    small = session.materialize(spark.range(90, numPartitions=1))
    assert small.rdd.getNumPartitions() == 1
    session.drop_table(small)
    monkeypatch.undo()
    tasks = session.task_count
    assert [tasks(n, 12) for n in (0, 1, 600_000, 6_000_000, 60_000_000)] == [0, 1, 2, 12, 12]
    assert [tasks(n * session.TASK_CELLS, 12) for n in (12, 13, 24, 25)] == [12, 24, 24, 36]


def test_training_frames_leave_memory_to_the_fits(spark):
    df = session.materialize(spark.range(10).toDF("x"))
    assert df.storageLevel.useDisk and not df.storageLevel.useMemory
    session.drop_table(df)


def test_soft_vote_converts_a_vector_once(spark):
    """Not at each position of the mean: the plan holds one conversion per voter. Columns keep their places."""
    rows = [(1, Vectors.dense(0.2, 0.8), 9.0, Vectors.dense(0.6, 0.3)), (2, Vectors.dense(0.9, 0.1), 9.0, Vectors.dense(0.5, 0.25, 0.25))]
    df = spark.createDataFrame(rows, StructType([StructField("id", LongType()), StructField("p", VectorUDT()), StructField("mean", DoubleType()), StructField("q", VectorUDT())]))
    out = soft_vote(df, ["p", "q"], "vote", "mean")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("UDF(") == 2
    assert out.columns == ["id", "p", "mean", "q", "vote"]
    found = {r["id"]: ([round(x, 6) for x in r["mean"]], r["vote"]) for r in out.collect()}
    assert found == {1: ([0.4, 0.55], 1.0), 2: ([0.7, 0.175, 0.125], 0.0)}


def test_wide_stages_run_in_methods_the_jvm_compiles(spark, monkeypatch):
    """What an experiment writes and fits runs under the limit; the caller's setting comes back, a lower one stays."""
    from pyspark.sql.readwriter import DataFrameWriter

    from flowguard.plans import experiment

    seen, write, fit = [], DataFrameWriter.parquet, experiment.train_models
    limit = lambda: int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
    before = limit()
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: (seen.append(("write", limit())), write(*a, **k))[1])
    monkeypatch.setattr(experiment, "train_models", lambda *a, **k: (seen.append(("fit", limit())), fit(*a, **k))[1])
    rows = spark.range(60).select((F.col("id") % 7).cast("double").alias("x"), F.col("id").cast("double").alias("y"),
                                  F.when(F.col("id") % 3 == 0, "BENIGN").otherwise("DDoS").alias("label"))
    experiment.run_experiment(rows, ExperimentConfig(split="random", sample_fraction=1.0, models=("nb",))).release(results=True)
    assert {kind for kind, _ in seen} == {"write", "fit"}
    assert seen[0] == ("write", 8000) and all(n == 8000 for kind, n in seen if kind == "fit") and limit() == before
    with session.compiled_methods(spark), session.compiled_methods(spark):
        assert limit() == 8000
    assert limit() == before
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "500")
    try:
        with session.compiled_methods(spark):
            assert limit() == 500
        assert limit() == 500
    finally:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")


def _kdd_line(**cells):
    line = [str(i) for i in range(41)] + ["normal."]
    for place, cell in cells.items():
        line[int(place[1:])] = cell
    return ",".join(line)


def test_kdd_lines_are_cut_as_the_csv_reader_cuts_them(spark, tmp_path):
    """Plain lines at their commas, others by the parser; each number is made once for the filter and the rows."""
    from flowguard.plans.experiment import prepare
    from flowguard.session import made_once

    line = _kdd_line
    lines = [line(), line(c1='"a,b"'), line(c1='a"b'), line(c1='\\"x'), line(c0=" 1.5 ", c1=" tcp "), line(c0="", c1="", c41=""), line(c1='""'),
             line(c0="inf", c4="NaN", c5="-Infinity", c6="1e400", c7="1d", c8="x", c9='"7"'), "   ", "", "\t", "\x00", line(c1="é😀", c41="back.."),
             line(c2="\\"), line(c1="a\x00b"), "\x00" + line(), "#" + line(), line(c3='"open'), line(c1='"a""b"'), line() + ",9", line() + ",", "a,b", ",", "," * 41, "," * 42]
    (tmp_path / "kdd").write_bytes("\n".join(lines).encode() + b"\r\n" + line(c1="\xff").encode("latin1") + b"\r" + line(c1="last").encode())
    names = [*flow_csv.KDD_COLUMNS, flow_csv.RAGGED]
    raw = (spark.read.schema(", ".join(f"`{c}` string" for c in names)).option("columnNameOfCorruptRecord", flow_csv.RAGGED)
           .option("columnPruning", False).csv(str(tmp_path / "kdd")))
    meant = flow_csv.strip_label_dot(flow_csv.cast_numeric(raw, flow_csv.KDD_NUMERIC), "label")
    found = flow_csv.read_kdd(spark, str(tmp_path / "kdd"), rejects=True)
    rows = lambda df: sorted(map(repr, df.select(names).collect()))
    assert rows(found) == rows(meant) and len(rows(found)) > 20
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        strict = prepare(made_once(flow_csv.read_kdd(spark, str(tmp_path / "kdd"))), ExperimentConfig(dataset="kdd"))
        plan = strict._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("try_cast(") == len(flow_csv.KDD_NUMERIC) and plan.count("split(") == 1


def test_kdd_lines_are_the_csv_writers(spark, tmp_path):
    """Byte for byte, whether the writer is asked for a row or not."""
    from flowguard.checks.q_sources import kdd_frame

    texts = ["tcp", None, "", "a,b", 'a"b', "a\\b", " lead", "trail ", "a b", "#c", "x\ny", "x\n", "é", "\t", "normal.", "-"]
    numbers = [1.0, None, float("nan"), float("inf"), -0.0, 1e300, 1e-7, 3.0]
    rows = [(t, numbers[i % 8]) for i, t in enumerate(texts)]
    odd = spark.createDataFrame(rows, "t string, x double").coalesce(1)
    odd = odd.select([F.col("t" if c in ("protocol_type", "flag", "label") else "x").alias(c) for c in flow_csv.KDD_COLUMNS])
    for name, df in (("odd", odd), ("texts", odd.select([F.col(c).cast("string") for c in flow_csv.KDD_COLUMNS])), ("flows", kdd_frame(spark, SF_SMALL))):
        flow_csv.write_kdd_csv(df, str(tmp_path / name))
        df.select([F.col(c).cast("string") for c in flow_csv.KDD_COLUMNS]).write.csv(str(tmp_path / f"{name}-csv"))
        content = [b"".join(f.read_bytes() for f in sorted((tmp_path / n).glob("part-*"))) for n in (name, f"{name}-csv")]
        assert content[0] == content[1] != b""


def test_training_rows_are_not_written_again(spark):
    """They are cached from the prepared table, dealt evenly by their draws; ``release`` leaves the caller's table."""
    from flowguard.plans.experiment import prepare_flows

    slots = spark.sparkContext.defaultParallelism
    cfg = ExperimentConfig(mode="multiclass", split="random", sample_fraction=1.0, models=("nb",), class_weights=False)
    flows = prepare_flows(lineitem_flows(spark, SF_SMALL).drop("l_orderkey", "l_linenumber"), cfg)
    scratch = pathlib.Path(checkpoint_dir(spark).removeprefix("file:")) / "flowguard-scratch"
    before = {f.name for f in scratch.iterdir()}
    res = run_experiment(flows, cfg)
    assert {f.name.split("-")[0] for f in scratch.iterdir() if f.name not in before} == {"confusion"}
    train, = res.persisted
    assert train.columns == ["label_idx", "features"] and train.storageLevel.useDisk and not train.storageLevel.useMemory
    res.release()
    assert not train.storageLevel.useDisk and flows.rows.count() == 6000
    flows.release()
    drawn = spark.range(300_000, numPartitions=1).withColumn("d", F.xxhash64("id") % 1000003)
    df = session.dealt(drawn, 300_000, "d")
    held = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert df.columns == ["id"] and len(held) == min(slots, 6) and sum(held) == 300_000 and max(held) < 1.1 * 300_000 / len(held)
    df.unpersist()
