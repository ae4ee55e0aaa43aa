"""Classification metrics from ONE confusion aggregation.

The scored test frame (one row per flow, one prediction column per model) is unpivoted to
(model, label, prediction) and counted in a single ``groupBy`` with map-side partial
aggregation. The result has at most models x classes^2 rows; every metric below is
computed from that small table, so the large data is scanned once for all models.

Semantics (MLlib ``MulticlassMetrics`` / ``MulticlassClassificationEvaluator``):
  precision(k) = tp / predicted(k), 0 when k is never predicted
  recall(k)    = tp / support(k), 0 when k never occurs in the labels (the reference raises)
  f1(k)        = 2 p r / (p + r), 0 when p + r = 0
  accuracy     = sum tp / total;  weighted X = sum X(k) support(k) / total (labels only)
  macro-F1     = mean f1 over classes seen in labels OR predictions
A null prediction (an abstaining voter) counts as wrong: it adds to support, not to any class.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.exprs import label_name_expr, qcol

METRIC_COLUMNS = ("accuracy", "precision", "recall", "f1_weighted", "f1_macro")


def _as_pairs(pred_cols: Mapping[str, str] | Sequence[str]) -> list[tuple[str, str]]:
    if isinstance(pred_cols, Mapping):
        return list(pred_cols.items())
    return [(c.removeprefix("pred_"), c) for c in pred_cols]


def long_predictions(
    df: DataFrame, label_col: str, pred_cols: Mapping[str, str] | Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """(by, model, position, label_idx, prediction): one row per flow and model (a Generate, no shuffle)."""
    pairs = _as_pairs(pred_cols)
    rows = F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(i).alias("position"), qcol(c).cast("double").alias("prediction"))
        for i, (m, c) in enumerate(pairs)
    ])
    keep = [qcol(b).alias(b) for b in by]
    return df.select(*keep, qcol(label_col).cast("double").alias("label_idx"), F.inline(rows)).select(
        *map(qcol, by), "model", "position", "label_idx", "prediction"
    )


def confusion_counts(
    df: DataFrame, label_col: str, pred_cols: Mapping[str, str] | Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """([by,] model, position, label_idx, prediction, count) for all models (and groups) in one aggregation."""
    long = long_predictions(df, label_col, pred_cols, by).filter(F.col("label_idx").isNotNull())
    return long.groupBy(*map(qcol, by), "model", "position", "label_idx", "prediction").agg(F.count(F.lit(1)).alias("count"))


def confusion_by_index(df: DataFrame, label_col: str = "label_idx", pred_col: str = "prediction") -> DataFrame:
    """Count per (label_idx, prediction) for one prediction column."""
    return (
        df.groupBy(qcol(label_col).cast("double").alias("label_idx"), qcol(pred_col).cast("double").alias("prediction"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def confusion_by_label(confusion: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Confusion counts with class names (index n -> ``__unknown``), by count desc."""
    named = confusion.select(
        *[c for c in ("model", "position") if c in confusion.columns],
        label_name_expr(F.col("label_idx"), labels).alias("actual_label"),
        label_name_expr(F.col("prediction"), labels).alias("predicted_label"),
        "count",
    )
    order = [c for c in ("position",) if c in confusion.columns]
    return named.orderBy(*order, F.desc("count"), "actual_label", "predicted_label")


def distinct_classes(confusion: DataFrame) -> DataFrame:
    """(model, class_idx): sorted set of indices in labels or predictions, per model."""
    keys = [c for c in ("model", "position") if c in confusion.columns]
    seen = confusion.select(*keys, F.col("label_idx").alias("class_idx")).unionByName(
        confusion.select(*keys, F.col("prediction").alias("class_idx"))
    )
    return seen.filter(F.col("class_idx").isNotNull()).distinct().orderBy(*keys, "class_idx")


def per_class_metrics(confusion: DataFrame, labels: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """([by,] model, position, label_idx, [class_label,] precision, recall, f1, support) per class seen."""
    keys = [*by, *[c for c in ("model", "position") if c in confusion.columns]]
    zero = F.lit(0).cast("long")
    roles = F.array(
        F.struct(
            F.col("label_idx").alias("k"),
            F.col("count").alias("support"),
            F.when(F.col("prediction") == F.col("label_idx"), F.col("count")).otherwise(zero).alias("tp"),
            zero.alias("predicted"),
        ),
        F.struct(F.col("prediction").alias("k"), zero.alias("support"), zero.alias("tp"), F.col("count").alias("predicted")),
    )
    per = (
        confusion.select(*keys, F.inline(roles))
        .filter(F.col("k").isNotNull())
        .groupBy(*keys, "k")
        .agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"))
    )
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.withColumn("precision", p).withColumn("recall", r)
    pr = F.col("precision") + F.col("recall")
    f1 = F.when(pr == 0, F.lit(0.0)).otherwise(F.lit(2.0) * F.col("precision") * F.col("recall") / pr)
    out = per.withColumn("f1", f1).withColumnRenamed("k", "label_idx")
    cols = [*keys, "label_idx"]
    if labels is not None:
        out = out.withColumn("class_label", label_name_expr(F.col("label_idx"), labels))
        cols.append("class_label")
    return out.select(*cols, "precision", "recall", "f1", "support", "tp")


def model_metrics(per_class: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """([by,] model, position, accuracy, precision, recall, f1_weighted, f1_macro) from per-class rows."""
    keys = [*by, *[c for c in ("model", "position") if c in per_class.columns]]
    total = F.sum("support")

    def weighted(c: str):
        return F.coalesce(F.sum(F.col(c) * F.col("support")) / total, F.lit(0.0))

    return per_class.groupBy(*keys).agg(
        F.coalesce(F.sum("tp") / total, F.lit(0.0)).alias("accuracy"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        weighted("f1").alias("f1_weighted"),
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("f1_macro"),
    )


def compute_metrics(
    df: DataFrame, label_col: str, pred_cols: Mapping[str, str] | Sequence[str], labels: Sequence[str] | None = None,
    by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(confusion, per_class, metrics) for every prediction column of a scored frame, per group of ``by`` (e.g. the day)."""
    conf = confusion_counts(df, label_col, pred_cols, by)
    per = per_class_metrics(conf, labels, by)
    return conf, per, model_metrics(per, by)


def metric_column(metrics: DataFrame, name: str) -> DataFrame:
    """One metric per model (accuracy, precision (weighted), recall (weighted), f1_weighted, f1_macro)."""
    keys = [c for c in ("model", "position") if c in metrics.columns]
    return metrics.select(*keys, name)
