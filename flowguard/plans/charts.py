"""Chart data as tables (the reference draws PNGs; we hand over the rows a chart needs).

All inputs are result tables (per model, per class, per model and class); pivots take their
value lists from those tables (bounded by the number of models or classes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.functions.exprs import pretty_model_name_expr
from flowguard.operators.metrics import confusion_by_label

CHART_METRICS = ("accuracy", "precision", "recall", "f1_macro")


def pretty_model_name(df: DataFrame, col: str = "model", output_col: str = "display_name") -> DataFrame:
    return df.withColumn(output_col, pretty_model_name_expr(F.col(col)))


def chart_label_counts(label_dist: DataFrame) -> DataFrame:
    """Bars per label (the label distribution itself)."""
    return label_dist.select("label", "count")


def chart_model_f1(comparison: DataFrame) -> DataFrame:
    """Models by macro-F1 (ascending, for horizontal bars), tagged single / ensemble."""
    kind = F.when(F.col("model").contains("ensemble"), F.lit("ensemble")).otherwise(F.lit("single"))
    out = comparison.select("model", pretty_model_name_expr(F.col("model")).alias("display_name"),
                            kind.alias("kind"), "f1_macro", "position")
    return out.orderBy("f1_macro", F.desc("position"))


def chart_multi_metric(comparison: DataFrame) -> DataFrame:
    """Model x metric in long form for grouped bars (4 metrics)."""
    base = comparison.select("model", "position", *CHART_METRICS)
    return base.unpivot(["model", "position"], list(CHART_METRICS), "metric", "value")


def chart_single_vs_ensemble(comparison: DataFrame) -> DataFrame:
    """Two ranked lists: rank within kind by macro-F1."""
    w = Window.partitionBy("kind").orderBy(F.desc("f1_macro"), "position")
    return comparison.select("kind", "model", "f1_macro", F.row_number().over(w).alias("rank_in_kind"))


def chart_class_f1_heatmap(per_class: DataFrame) -> DataFrame:
    """class x model matrix of F1 (one column per model)."""
    models = [r["model"] for r in per_class.select("model", "position").distinct().orderBy("position").collect()]
    return per_class.groupBy("class_label").pivot("model", models).agg(F.first("f1"))


def chart_accuracy_recall(comparison: DataFrame) -> DataFrame:
    return comparison.select("model", "kind", "recall", "accuracy")


def chart_accuracy_f1(comparison: DataFrame) -> DataFrame:
    return comparison.select("model", "kind", "accuracy", "f1_macro")


def chart_training_time(comparison: DataFrame) -> DataFrame:
    """Models by training seconds (models without a fit: 0.0, as in the exported CSV)."""
    secs = F.coalesce(F.col("train_time_sec"), F.lit(0.0))
    return comparison.select("model", secs.alias("train_time_sec"), "position").orderBy("train_time_sec", "position")


def chart_ensemble_gain(comparison: DataFrame) -> DataFrame:
    """Best single model vs each ensemble on 4 metrics; empty when either side is missing.

    The best single row is picked with ``max_by`` (one aggregation) and attached to every
    ensemble row through an equi-join on the metric name after unpivoting both sides.
    """
    singles = comparison.filter(F.col("kind") == "single")
    best = singles.agg(
        F.max_by(F.struct("model", *CHART_METRICS), F.struct(F.col("f1_macro"), (-F.col("position")).alias("p"))).alias("b")
    ).select("b.*").filter(F.col("model").isNotNull())
    best_long = best.unpivot(["model"], list(CHART_METRICS), "metric", "best_single_value").withColumnRenamed(
        "model", "best_single")
    ens = comparison.filter(F.col("kind") == "ensemble").select("model", *CHART_METRICS)
    ens_long = ens.unpivot(["model"], list(CHART_METRICS), "metric", "ensemble_value").withColumnRenamed(
        "model", "ensemble")
    joined = ens_long.join(F.broadcast(best_long), "metric", "inner")
    return joined.select("ensemble", "best_single", "metric", "best_single_value", "ensemble_value",
                         (F.col("ensemble_value") - F.col("best_single_value")).alias("gain"))


def chart_confusion_dense(confusion: DataFrame, labels: list[str], model: str) -> DataFrame:
    """Square matrix over classes seen in labels or predictions of ``model``; empty cells are 0.

    Every class gets a zero diagonal entry first, so classes that only appear as predictions
    still have a row and a column; then one ``pivot`` with the class list as values.
    """
    named = confusion_by_label(confusion.filter(F.col("model") == model), labels).filter(
        F.col("predicted_label").isNotNull())
    classes = named.select(F.col("actual_label").alias("k")).union(named.select(F.col("predicted_label").alias("k"))).distinct()
    zeros = classes.select(F.col("k").alias("actual_label"), F.col("k").alias("predicted_label"),
                           F.lit(0).cast("long").alias("count"))
    cells = named.select("actual_label", "predicted_label", "count").unionByName(zeros)
    values = sorted(r["k"] for r in classes.collect())  # one name per class
    return cells.groupBy("actual_label").pivot("predicted_label", values).agg(F.sum("count")).fillna(0)
