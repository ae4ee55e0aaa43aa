"""Report Tables I-VI and key findings as DataFrames (the reference formats them as text/LaTeX)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.exprs import pretty_model_name_expr
from flowguard.operators.ranking import ensemble_rows, rank_models, single_rows


def _kv(df: DataFrame, pairs: list[tuple[str, object]]) -> DataFrame:
    """Key/value rows from (key, Column-or-literal) pairs, evaluated over ``df`` in one aggregation."""
    cols = [F.struct(F.lit(k).alias("key"), (v if not isinstance(v, (str, int, float, bool)) else F.lit(v))
                     .cast("string").alias("value")) for k, v in pairs]
    return df.agg(F.array(*cols).alias("kv")).select(F.inline("kv"))


def report_config(label_counts: DataFrame, dataset: str, profile: str, mode: str, split: str, sample_fraction: float,
                  class_weights: bool, fast: bool) -> DataFrame:
    """Table I: run configuration and the total number of prepared records (before split and sample)."""
    return _kv(label_counts, [
        ("dataset", dataset), ("data_profile", profile), ("classification", mode), ("split", split),
        ("sample_fraction", f"{sample_fraction:.0%}"), ("class_weights", str(class_weights)), ("fast_mode", str(fast)),
        ("total_records", F.coalesce(F.sum("count"), F.lit(0))),
    ])


def report_findings(comparison: DataFrame) -> DataFrame:
    """Key findings: best single classifier and best overall method (by macro-F1), display names."""
    key = F.struct(F.col("f1_macro"), (-F.col("position")).alias("p"))
    best = comparison.agg(
        F.max_by(F.when(F.col("kind") == "single", F.col("model")), F.when(F.col("kind") == "single", key)).alias("s"),
        F.max_by("model", key).alias("o"),
    )
    return best.select(F.inline(F.array(
        F.struct(F.lit("best_single").alias("key"), pretty_model_name_expr(F.col("s")).alias("value")),
        F.struct(F.lit("best_overall").alias("key"), pretty_model_name_expr(F.col("o")).alias("value")),
    )))


def report_tables(distribution: DataFrame, comparison: DataFrame, per_class: DataFrame, config_rows: DataFrame) -> dict[str, DataFrame]:
    """Tables I-VI + findings. Table VI is the per-class table of the best overall method."""
    key = F.struct(F.col("f1_macro"), (-F.col("position")).alias("p"))
    best = comparison.agg(F.max_by("model", key).alias("best_overall"))
    table6 = per_class.join(F.broadcast(best), per_class["model"] == best["best_overall"], "inner").drop("best_overall")
    return {
        "table1_configuration": config_rows,
        "table2_label_distribution": distribution,
        "table3_single_models": single_rows(comparison).orderBy(F.desc("f1_macro"), "position"),
        "table4_ensembles": ensemble_rows(comparison).orderBy(F.desc("f1_macro"), "position"),
        "table5_ranking": rank_models(comparison),
        "table6_per_class_best": table6,
        "key_findings": report_findings(comparison),
    }
