"""End-to-end experiment: prepare -> split -> sample -> fit features -> train -> score -> vote -> metrics.

Data movement:
  * the raw flows are read once: the prepared rows are written as a parquet table in the shared
    folder with a random draw per row, and every split of it is a filter;
  * the feature pipeline fit reads the training part once (StringIndexer counts);
  * the assembled training frame is dealt out evenly and persisted on disk, because every MLlib fit
    reads it some times (lost executors recompute from the prepared table);
  * the test part is read ONCE: all models score it in a chain of ``transform`` calls, the
    votes are column expressions, and one ``groupBy`` produces the confusion counts of every
    model; that table (models x classes^2 rows) is checkpointed and feeds all metrics.
No join lines predictions up, and no metric pulls rows to the driver.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from flowguard.config import ENSEMBLE_HARD, ENSEMBLE_SOFT, ExperimentConfig
from flowguard.functions.exprs import qcol
from flowguard.operators.clean import drop_incomplete, feature_columns
from flowguard.operators.ensemble import hard_vote, soft_vote
from flowguard.operators.features import feature_pipeline, label_counts
from flowguard.operators.labels import prepare_labels
from flowguard.operators.metrics import confusion_counts, model_metrics, per_class_metrics
from flowguard.operators.models import has_probability, pred_col, prob_col, score_models, select_models, train_models
from flowguard.operators.ranking import comparison_table
from flowguard.operators.split import DRAW, DRAWS, sample_splits, split_dispatch, with_draw
from flowguard.operators.weights import add_weights_from_counts
from flowguard.session import compiled_methods, dealt, drop_path, drop_table, made_once, scratch_path, write_table
from flowguard.sources.flow_csv import RAGGED


@dataclass
class Evaluation:
    labels: list[str]
    models: list[str]
    scored: DataFrame
    confusion: DataFrame
    per_class: DataFrame
    metrics: DataFrame
    comparison: DataFrame


def evaluate(
    scored: DataFrame,
    label_col: str,
    singles: Sequence[tuple[str, str, str | None]],
    labels: Sequence[str],
    train_times: dict[str, float] | None = None,
    ensembles: bool = True,
    persist_confusion: bool = False,
    only: Sequence[str] | None = None,
) -> Evaluation:
    """Votes (with >= 2 models) + metrics for prediction columns of one scored frame.

    ``singles`` lists (model, prediction column, probability column or None) in order; ``only``
    counts just those models (columns of the others are then pruned from the plan by Catalyst).
    """
    pred_map = {name: p for name, p, _ in singles}
    if ensembles and len(singles) >= 2:
        hard_col = pred_col(ENSEMBLE_HARD)
        scored = hard_vote(scored, [p for _, p, _ in singles], hard_col)
        pred_map[ENSEMBLE_HARD] = hard_col
        # Soft vote over the models that give probabilities (one-vs-rest models give none).
        with_prob = [pr for _, _, pr in singles if pr]
        if len(with_prob) >= 2:
            soft_col = pred_col(ENSEMBLE_SOFT)
            scored = soft_vote(scored, with_prob, soft_col, prob_col(ENSEMBLE_SOFT))
            pred_map[ENSEMBLE_SOFT] = soft_col
    if only is not None:
        pred_map = {m: c for m, c in pred_map.items() if m in set(only)}
    conf = confusion_counts(scored, label_col, pred_map)
    if persist_confusion:
        conf = write_table(conf, "confusion")
    per = per_class_metrics(conf, labels)
    metrics = model_metrics(per)
    comp = comparison_table(metrics, train_times)
    return Evaluation(list(labels), list(pred_map), scored, conf, per, metrics, comp)


@dataclass
class ExperimentResult:
    config: ExperimentConfig
    labels: list[str]
    models: list[str]
    skipped: dict[str, str]
    train_times: dict[str, float]
    evaluation: Evaluation
    prepared: DataFrame
    label_counts: DataFrame
    split_summary: DataFrame
    prep_model: object = None
    fitted: list = field(default_factory=list)
    best_single: str | None = None
    best_overall: str | None = None
    persisted: list = field(default_factory=list)
    owned: PreparedFlows | None = None  # flows that the experiment prepared itself

    @property
    def comparison(self) -> DataFrame:
        return self.evaluation.comparison

    @property
    def per_class(self) -> DataFrame:
        return self.evaluation.per_class

    @property
    def confusion(self) -> DataFrame:
        return self.evaluation.confusion

    def release(self, results: bool = False) -> None:
        """Let go of what the results no longer need: the cached training set and the tables of own prepared rows.

        With ``results`` also the tables that the results read (confusion, own label counts): nothing is left.
        """
        for df in self.persisted:
            df.unpersist()
        self.persisted = []
        if self.owned:
            self.owned.release(results)
        if results:
            drop_table(self.confusion)


def prepare(df: DataFrame, cfg: ExperimentConfig) -> DataFrame:
    """Rows without a null, with their labels prepared."""
    return prepare_labels(drop_incomplete(df), cfg.mode, cfg.normal_label, cfg.label_col)


@dataclass
class PreparedFlows:
    """Prepared rows in the shared folder, their labels by source, and the records that were no rows."""

    rows: DataFrame                     # with a draw each (``with_draw``) if a random split or a sample asked for it
    counts: DataFrame                   # (label, source, count), a small table
    seed: int
    rejects: DataFrame | None = None    # (source_file, record) of the lines that were no rows
    observed: dict[str, int] = field(default_factory=dict)  # lines accepted and rejected, if the frame told them apart
    paths: list[str] = field(default_factory=list)

    def with_draws(self) -> DataFrame:
        """The rows with their draws, which are made now if nothing asked for them before."""
        if DRAW not in self.rows.columns:
            self.paths.append(scratch_path(self.rows.sparkSession, "prepared"))
            drawn = with_draw(self.rows, self.seed)
            drawn.write.parquet(self.paths[-1])
            self.rows = drawn.sparkSession.read.schema(drawn.schema).parquet(self.paths[-1])
        return self.rows

    def release(self, counts: bool = True) -> None:
        """Delete the rows and rejects, and the label counts unless results still read them."""
        while self.paths:
            drop_path(self.rows.sparkSession, self.paths.pop())
        if counts:
            drop_table(self.counts)


REJECTED = "__rejected"


def prepare_flows(df: DataFrame, cfg: ExperimentConfig, draws: bool | None = None) -> PreparedFlows:
    """The one pass over the raw flows; all that follows reads its table.

    A frame read with ``rejects`` is parted by that pass: rows and records that are none are written
    side by side, and counted on the way. ``draws``: whether rows get a draw now (default: if
    the configuration splits at random or samples).
    """
    spark, seen = df.sparkSession, None
    if RAGGED in df.columns:
        bad, seen = F.col(RAGGED).isNotNull(), Observation()
        values = [f for f in df.schema.fields if f.name != RAGGED]
        whole = [~F.isnan(qcol(f.name)) if f.dataType.typeName() in ("double", "float") else F.lit(True) for f in values]
        complete = functools.reduce(Column.__and__, [qcol(f.name).isNotNull() & w for f, w in zip(values, whole)])
        df = df.observe(seen, F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected")).filter(bad | complete)
        out = prepare_labels(df, cfg.mode, cfg.normal_label, cfg.label_col).withColumn(REJECTED, bad.cast("int"))
    else:
        out = prepare(made_once(df), cfg)
    if draws or draws is None and (cfg.split == "random" or min(cfg.sample_fraction, cfg.test_fraction) < 1.0):
        out = with_draw(out, cfg.seed, [c for c in out.columns if c not in (RAGGED, REJECTED)])
    path = scratch_path(spark, "prepared")
    with compiled_methods(spark):
        (out.write.partitionBy(REJECTED) if seen else out.write).parquet(path)
    rows, rejects = spark.read.schema(out.schema).parquet(path), None
    if seen:
        rejects = rows.filter(F.col(REJECTED) == 1).select(qcol(cfg.source_col).alias("source_file"), F.col(RAGGED).alias("record"))
        rows = rows.filter(F.col(REJECTED) == 0).drop(REJECTED, RAGGED)
    source = qcol(cfg.source_col) if cfg.source_col in rows.columns else F.lit(None).cast("string")
    counts = rows.groupBy(qcol(cfg.label_col).alias("label"), source.alias("source")).agg(F.count(F.lit(1)).alias("count"))
    return PreparedFlows(rows, write_table(counts, "prepared-counts"), cfg.seed, rejects, dict(seen.get) if seen else {}, [path])


def split_prepared(flows: PreparedFlows, cfg: ExperimentConfig, key_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Train and test part of the prepared table, as filters; rows keep their draws, if they have any."""
    random = cfg.split == "random"
    rows = flows.with_draws() if random or min(cfg.sample_fraction, cfg.test_fraction) < 1.0 else flows.rows
    if random:
        low = F.col(DRAW) < int(cfg.train_fraction * DRAWS)
        return tuple(rows.filter(part).drop(cfg.source_col) for part in (low, ~low))
    if cfg.split == "file":
        listed = {*cfg.train_sources, *cfg.test_sources}
        found = {r["source"] for r in flows.counts.filter(F.col("source").isin(list(listed))).select("source").distinct().collect()}
        if listed - found:
            raise ValueError(f"no rows from listed sources: {', '.join(sorted(listed - found))}")
    return split_dispatch(rows, cfg.split, cfg.train_sources, cfg.test_sources, cfg.train_fraction, cfg.seed, key_cols, cfg.source_col)


def run_experiment(
    df: DataFrame | PreparedFlows,
    cfg: ExperimentConfig,
    feature_cols: Sequence[str] | None = None,
    key_cols: Sequence[str] = (),
) -> ExperimentResult:
    """One experiment over a loaded flow table (``label`` + features [+ ``source_file``]), or over prepared flows.

    Prepared flows are the caller's; those made here are deleted by the result's ``release``. A failing
    experiment deletes what it wrote.
    """
    own = None if isinstance(df, PreparedFlows) else prepare_flows(df, cfg)
    scratch: list[DataFrame] = []
    try:
        with compiled_methods((own or df).rows.sparkSession):
            result = _run(own or df, cfg, feature_cols, tuple(key_cols) or cfg.key_cols, scratch)
    except BaseException:
        for frame in scratch:
            frame.unpersist()
        if own:
            own.release()
        raise
    result.owned = own
    return result


def _run(flows: PreparedFlows, cfg: ExperimentConfig, feature_cols: Sequence[str] | None, key_cols: Sequence[str], scratch: list[DataFrame]) -> ExperimentResult:
    prepared = flows.rows.drop(DRAW)
    skip = {cfg.label_col, cfg.source_col, *key_cols}
    feats = list(feature_cols) if feature_cols else list(feature_columns(prepared, skip))

    train, test = split_prepared(flows, cfg, key_cols)
    train, test = sample_splits(train, test, cfg.sample_fraction, cfg.seed, cfg.test_fraction)
    draw = [DRAW] if DRAW in train.columns else []

    # One aggregation over the training part gives the label order (StringIndexer's rule)
    # and the class counts for the weights; the label stage is then pre-fitted.
    counts = label_counts(train, cfg.label_col)
    labels = [lbl for lbl, _ in counts]
    names, skipped = select_models(cfg, n_classes=len(labels))  # an impossible choice fails before anything is written
    pipeline = feature_pipeline(feats, cfg.categorical, cfg.label_col, cfg.keep_categorical_metadata, labels)
    prep_model = pipeline.fit(train)  # a pass only when categorical columns need indexing
    train_p = prep_model.transform(train).select("label_idx", "features", *draw)
    if cfg.class_weights:
        train_p = add_weights_from_counts(train_p, counts, "label_idx")
    train_p = dealt(train_p, sum(n for _, n in counts), *draw)
    scratch.append(train_p)
    test_p = prep_model.transform(test).select("label_idx", "features")

    fitted = train_models(train_p, names, cfg, n_classes=len(labels))
    times = {name: secs for name, _, secs in fitted}
    scored = score_models(test_p, fitted)
    singles = [(n, pred_col(n), prob_col(n) if has_probability(m) else None) for n, m, _ in fitted]
    ev = evaluate(scored, "label_idx", singles, labels, times, persist_confusion=True)
    # Rows that reached the models: training rows (persisted) and test rows (confusion totals).
    n_train = train_p.count()
    n_test = ev.confusion.filter(F.col("position") == 0).agg(F.sum("count")).first()[0] or 0
    summary = split_summary_from_counts(prepared.sparkSession, n_train, n_test)
    best = ev.comparison.select("model", "position", "kind", "f1_macro").collect()  # one row per model
    ordered = sorted(best, key=lambda r: (-(r["f1_macro"] or 0.0), r["position"]))
    singles_only = [r for r in ordered if r["kind"] == "single"]
    return ExperimentResult(
        config=cfg,
        labels=labels,
        models=ev.models,
        skipped=skipped,
        train_times=times,
        evaluation=ev,
        prepared=prepared,
        label_counts=flows.counts.groupBy("label").agg(F.sum("count").alias("count")),
        split_summary=summary,
        prep_model=prep_model,
        fitted=fitted,
        best_single=singles_only[0]["model"] if singles_only else None,
        best_overall=ordered[0]["model"] if ordered else None,
        persisted=[train_p],
    )


def split_summary_from_counts(spark, n_train: int, n_test: int) -> DataFrame:
    """Split summary table from two counts already known (no extra pass over the data)."""
    total = n_train + n_test
    rows = [("train", n_train, round(n_train * 100.0 / total, 4) if total else 0.0),
            ("test", n_test, round(n_test * 100.0 / total, 4) if total else 0.0)]
    return spark.createDataFrame(rows, "split string, count long, percent double")


def run_both_splits(
    df: DataFrame | PreparedFlows, cfg: ExperimentConfig, feature_cols: Sequence[str] | None = None, key_cols: Sequence[str] = ()
) -> dict[str, ExperimentResult]:
    """Random-split and file-split experiments over one prepared table (stops at the first failure)."""
    own = None if isinstance(df, PreparedFlows) else prepare_flows(df, cfg, draws=True)
    results: dict[str, ExperimentResult] = {}
    try:
        for split in ("random", "file"):
            results[split] = run_experiment(own or df, cfg.with_(split=split), feature_cols, key_cols)
    except BaseException:
        for r in results.values():
            r.release(results=True)
        if own:
            own.release()
        raise
    if own:
        results["file"].owned = own  # released last
    return results


def tagged_comparison(results: dict[str, ExperimentResult]) -> DataFrame:
    """Comparison tables of several experiments in one frame with a ``split`` column."""
    frames = [r.comparison.withColumn("split", F.lit(k)) for k, r in results.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
