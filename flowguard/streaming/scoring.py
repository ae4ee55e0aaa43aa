"""Scoring flow streams with a fitted experiment (Structured Streaming).

The reference is batch-only; this module adds no operators of its own. It applies the same
fitted feature pipeline, models and vote expressions to a streaming DataFrame (all of them
are per-row transformations, so they run unchanged on micro-batches) and keeps running
confusion counts with the same single aggregation the batch metrics use. The state of that
aggregation is one row per (model, label, prediction): bounded by models x classes^2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.config import ENSEMBLE_HARD, ENSEMBLE_SOFT
from flowguard.operators.ensemble import hard_vote, soft_vote
from flowguard.operators.metrics import confusion_counts
from flowguard.operators.models import has_probability, pred_col, prob_col, score_models
from flowguard.plans.experiment import ExperimentResult, prepare


def score_stream(stream: DataFrame, result: ExperimentResult, keep: Sequence[str] = ()) -> DataFrame:
    """Streaming flows -> label index, every model's prediction and both votes (stateless)."""
    prepared = prepare(stream, result.config)
    features = result.prep_model.transform(prepared).select(*keep, "label_idx", "features")
    scored = score_models(features, result.fitted)
    names = [n for n, _, _ in result.fitted]
    if len(names) >= 2:
        scored = hard_vote(scored, [pred_col(n) for n in names], pred_col(ENSEMBLE_HARD))
        probs = [prob_col(n) for n, m, _ in result.fitted if has_probability(m)]
        if len(probs) >= 2:
            scored = soft_vote(scored, probs, pred_col(ENSEMBLE_SOFT), prob_col(ENSEMBLE_SOFT))
    return scored


def prediction_columns(result: ExperimentResult) -> dict[str, str]:
    names = [n for n, _, _ in result.fitted]
    out = {n: pred_col(n) for n in names}
    if len(names) >= 2:
        out[ENSEMBLE_HARD] = pred_col(ENSEMBLE_HARD)
        if sum(has_probability(m) for _, m, _ in result.fitted) >= 2:
            out[ENSEMBLE_SOFT] = pred_col(ENSEMBLE_SOFT)
    return out


def running_confusion(scored: DataFrame, result: ExperimentResult) -> DataFrame:
    """Running (model, position, label_idx, prediction, count); use output mode ``complete`` or ``update``."""
    return confusion_counts(scored, "label_idx", prediction_columns(result))


def running_accuracy(confusion_batch: DataFrame) -> DataFrame:
    """Per-model accuracy from one snapshot of the running confusion counts (a static frame)."""
    total = F.sum("count").over(Window.partitionBy("model"))
    hit = F.sum(F.when(F.col("label_idx") == F.col("prediction"), F.col("count")).otherwise(0)).over(
        Window.partitionBy("model"))
    return confusion_batch.select("model", (hit / total).alias("accuracy")).distinct()
