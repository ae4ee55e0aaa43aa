"""Comparison table, ranking and best-model selection (all on the per-model metrics table)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.config import ENSEMBLE_HARD, ENSEMBLE_SOFT
from flowguard.operators.metrics import METRIC_COLUMNS

ENSEMBLES = (ENSEMBLE_HARD, ENSEMBLE_SOFT)


def comparison_table(
    metrics: DataFrame,
    train_times: Mapping[str, float] | None = None,
    ensembles: Sequence[str] = ENSEMBLES,
) -> DataFrame:
    """(model, position, kind, accuracy, precision, recall, f1_weighted, f1_macro, train_time_sec).

    Training times are driver-side wall clocks (one per model) and enter as a literal map;
    models without a fit (ensembles, rule predictors) get null.
    """
    times = train_times or {}
    if times:
        tmap = F.create_map(*[x for m, t in times.items() for x in (F.lit(m), F.lit(float(t)))])
        time_col = F.element_at(tmap, F.col("model"))
    else:
        time_col = F.lit(None).cast("double")
    kind = F.when(F.col("model").isin(list(ensembles)), F.lit("ensemble")).otherwise(F.lit("single"))
    return metrics.select(
        "model", "position", kind.alias("kind"), *METRIC_COLUMNS, time_col.cast("double").alias("train_time_sec")
    )


def rank_models(comparison: DataFrame, by: str = "f1_macro", ascending: bool = False) -> DataFrame:
    """Rows ordered by ``by`` (desc by default), earlier position first on ties, with a ``rank``."""
    key = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    order = Window.orderBy(key, F.col("position"))
    return comparison.withColumn("rank", F.row_number().over(order)).orderBy("rank")


def single_rows(comparison: DataFrame) -> DataFrame:
    return comparison.filter(F.col("kind") == "single")


def ensemble_rows(comparison: DataFrame) -> DataFrame:
    return comparison.filter(F.col("kind") == "ensemble")


def _best(comparison: DataFrame, alias: str) -> DataFrame:
    # max_by over (f1, -position): highest macro-F1, the first model in order on ties.
    return comparison.agg(
        F.max_by("model", F.struct(F.col("f1_macro"), (-F.col("position")).alias("p"))).alias(alias),
        F.max("f1_macro").alias("f1_macro"),
    )


def best_single(comparison: DataFrame) -> DataFrame:
    return _best(single_rows(comparison), "best_single")


def best_overall(comparison: DataFrame) -> DataFrame:
    return _best(comparison, "best_overall")


def per_class_all(per_class: DataFrame) -> DataFrame:
    """Per-class rows of every model, long form keyed by model."""
    return per_class.orderBy("position", "label_idx")
