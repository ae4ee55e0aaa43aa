"""One call from raw captures to result files (the main entry point, as a function).

load (one scan per header layout) -> prepared table -> run_experiment (or both splits) -> result tables written
with Spark's writers below ``out_dir``: label distribution, comparison, single/ensemble split,
per-class metrics, confusion of the best single model, experiment JSON, report tables and
chart-data tables. Only small result tables are written; nothing is collected to the driver
except model names and class lists.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.config import KDD_CATEGORICAL, ExperimentConfig
from flowguard.operators.metrics import confusion_by_label
from flowguard.operators.profile import distribution_of
from flowguard.plans import charts, report
from flowguard.plans.experiment import ExperimentResult, prepare_flows, run_both_splits, run_experiment
from flowguard.sinks import writers
from flowguard.sources.flow_csv import KDD_NUMERIC, read_flow_csvs, read_kdd, resolve_profile, source_basename


def export_results(res: ExperimentResult, out_dir: str, dataset: str = "cicids", lines: dict[str, int] | None = None) -> dict[str, str]:
    """Write every result table of one experiment below ``out_dir``; returns name -> path. ``lines``: input lines accepted and rejected."""
    cfg = res.config
    out = out_dir.rstrip("/")
    paths: dict[str, str] = {}
    dist = distribution_of(res.label_counts)
    paths["label_distribution"] = writers.write_label_distribution(dist, f"{out}/label_distribution")
    cmp_path = writers.write_comparison(res.comparison, f"{out}/model_comparison")
    if cmp_path:
        paths["model_comparison"] = cmp_path
    paths.update(writers.write_single_ensemble(res.comparison, f"{out}/single_vs_ensemble"))
    paths["per_class_metrics"] = writers.write_per_class(res.per_class, f"{out}/per_class_metrics")
    if res.best_single:
        named = confusion_by_label(res.confusion.filter(F.col("model") == res.best_single), res.labels)
        paths["confusion_matrix"] = writers.write_confusion(named, f"{out}/confusion_matrix")
    record = writers.experiment_record(res.comparison, res.per_class, dataset, cfg.mode, cfg.split,
                                       cfg.train_sources, cfg.test_sources, [n for n, _, _ in res.fitted], res.skipped, lines)
    paths["experiment_results"] = writers.write_experiment_json(record, f"{out}/experiment_results")
    config_rows = report.report_config(res.label_counts, dataset, cfg.data_size, cfg.mode, cfg.split,
                                       cfg.sample_fraction, cfg.class_weights, cfg.fast)
    tables = report.report_tables(dist, res.comparison, res.per_class, config_rows)
    paths.update({f"report/{k}": v for k, v in writers.write_report_tables(tables, f"{out}/report").items()})
    chart_tables: dict[str, DataFrame] = {
        "model_f1": charts.chart_model_f1(res.comparison),
        "multi_metric": charts.chart_multi_metric(res.comparison),
        "single_vs_ensemble": charts.chart_single_vs_ensemble(res.comparison),
        "class_f1_heatmap": charts.chart_class_f1_heatmap(res.per_class),
        "accuracy_recall": charts.chart_accuracy_recall(res.comparison),
        "training_time": charts.chart_training_time(res.comparison),
        "ensemble_gain": charts.chart_ensemble_gain(res.comparison),
    }
    if res.best_single:
        chart_tables["confusion_dense"] = charts.chart_confusion_dense(res.confusion, res.labels, res.best_single)
    paths.update({f"charts/{k}": v for k, v in writers.write_report_tables(chart_tables, f"{out}/charts").items()})
    return paths


def run_and_export(
    spark: SparkSession, data_dir: str, out_dir: str, cfg: ExperimentConfig, both_splits: bool = False
) -> dict[str, dict[str, str]]:
    """Load the configured profile, run the experiment(s), write all result tables.

    With ``both_splits`` the random and file split run on one prepared table, written to
    ``out_dir/random`` and ``out_dir/file``. KDD is one file without capture days: a file split
    of it (alone or of both) becomes one random split, with a warning. Lines whose number of cells
    is not the header's are written to ``out_dir/rejected_lines`` with their source, and counted in the JSON.
    Scratch tables are deleted, after a failure too.
    """
    if cfg.dataset == "kdd" and (both_splits or cfg.split == "file"):
        warnings.warn("KDD has no capture days: the file split is replaced by one random split", stacklevel=2)
        cfg, both_splits = cfg.with_(split="random"), False
    train, test = resolve_profile(spark, data_dir, cfg.data_size, cfg.dataset)
    if cfg.dataset == "kdd":
        flows, features = read_kdd(spark, train[0], rejects=True), [*KDD_CATEGORICAL, *KDD_NUMERIC]
    else:
        flows, features = read_flow_csvs(spark, train + test, rejects=True), None
        if not cfg.train_sources:
            cfg = cfg.with_(train_sources=tuple(map(source_basename, train)), test_sources=tuple(map(source_basename, test)))
    prepared = prepare_flows(flows, cfg, draws=True if both_splits else None)
    results, written = {}, {}
    try:
        rejected = writers.write_rejects(prepared.rejects, f"{out_dir.rstrip('/')}/rejected_lines") if prepared.observed["rejected"] else None
        results = run_both_splits(prepared, cfg, features) if both_splits else {cfg.split: run_experiment(prepared, cfg, features)}
        for split, res in results.items():
            target = f"{out_dir.rstrip('/')}/{split}" if both_splits else out_dir
            written[split] = export_results(res, target, cfg.dataset, prepared.observed)
            if rejected:
                written[split]["rejected_lines"] = rejected
    finally:
        for res in results.values():
            res.release(results=True)
        prepared.release()
    return written
