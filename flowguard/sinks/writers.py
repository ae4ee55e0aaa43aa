"""Result-table writers (Spark CSV/JSON writers; folders are created on write).

Result tables are small by construction (classes, models, models x classes), so each is
written as a single ordered file (``coalesce(1)`` after the sort keeps the order). Numbers
are rounded as in the reference's files: metrics 6 decimals, seconds 2, percent 4.
"""

from __future__ import annotations

import datetime as _dt
import posixpath
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

COMPARISON_COLUMNS = ("model", "accuracy", "precision", "recall", "f1_weighted", "f1_macro", "train_time_sec")
COMPARISON_SCHEMA = StructType(
    [StructField("model", StringType())]
    + [StructField(c, DoubleType()) for c in COMPARISON_COLUMNS[1:]]
)
LABEL_DIST_SCHEMA = StructType(
    [StructField("label", StringType()), StructField("count", LongType()), StructField("percent", DoubleType())]
)
PER_CLASS_SCHEMA = StructType(
    [StructField("model", StringType()), StructField("class_label", StringType())]
    + [StructField(c, DoubleType()) for c in ("precision", "recall", "f1")]
    + [StructField("support", LongType())]
)
CONFUSION_SCHEMA = StructType(
    [StructField("actual_label", StringType()), StructField("predicted_label", StringType()), StructField("count", LongType())]
)


def _write_csv(df: DataFrame, path: str, order: Sequence = ()) -> str:
    out = df.orderBy(*order) if order else df
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_label_distribution(dist: DataFrame, path: str) -> str:
    """CSV ``label,count,percent`` (percent 4 decimals), by count desc."""
    out = dist.select("label", "count", F.round("percent", 4).alias("percent"))
    return _write_csv(out, path, [F.desc("count"), "label"])


def _comparison_rows(comparison: DataFrame) -> DataFrame:
    return comparison.select(
        "model",
        *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1_weighted", "f1_macro")],
        F.round(F.coalesce("train_time_sec", F.lit(0.0)), 2).alias("train_time_sec"),
        *[c for c in ("kind", "position") if c in comparison.columns],
    )


def write_comparison(comparison: DataFrame, path: str) -> str | None:
    """CSV of all models by macro-F1 desc; nothing written for an empty table."""
    if comparison.isEmpty():
        return None
    rows = _comparison_rows(comparison.orderBy(F.desc("f1_macro"), "position"))  # by the F1 itself, not its rounding
    return _write_csv(rows.select(*COMPARISON_COLUMNS), path)


def write_single_ensemble(comparison: DataFrame, path: str) -> dict[str, str]:
    """Single classifiers and ensembles by macro-F1 desc, a table each (``path/single``, ``path/ensemble``); an empty one is skipped."""
    out = {}
    for kind in ("single", "ensemble"):
        if written := write_comparison(comparison.filter(F.col("kind") == kind), f"{path.rstrip('/')}/{kind}"):
            out[f"{posixpath.basename(path.rstrip('/'))}/{kind}"] = written
    return out


def write_per_class(per_class: DataFrame, path: str) -> str:
    """CSV ``model,class_label,precision,recall,f1,support`` for all models."""
    out = per_class.select(
        "model", "class_label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support",
        *[c for c in ("position", "label_idx") if c in per_class.columns],
    )
    order = [c for c in ("position", "label_idx") if c in per_class.columns]
    out = out.orderBy(*order) if order else out
    return _write_csv(out.select("model", "class_label", "precision", "recall", "f1", "support"), path)


def write_confusion(confusion_named: DataFrame, path: str) -> str:
    """CSV ``actual_label,predicted_label,count``, largest cells first."""
    out = confusion_named.select("actual_label", "predicted_label", "count")
    return _write_csv(out, path, [F.desc("count"), "actual_label", "predicted_label"])


def experiment_record(
    comparison: DataFrame,
    per_class: DataFrame,
    dataset: str,
    mode: str,
    split: str,
    train_files: Sequence[str] = (),
    test_files: Sequence[str] = (),
    models: Sequence[str] = (),
    skipped: Mapping[str, str] | None = None,
    lines: Mapping[str, int] | None = None,
) -> DataFrame:
    """One nested row: run description, models (trained, and left out with the reason), the input lines
    accepted and rejected (``lines``; null if not counted), best models,
    comparison rows by macro-F1 desc and per-class rows by model and class.

    Both tables (one row per model / per model and class) are gathered by ONE aggregation
    over their union; best models come from ``max_by`` in the same pass.
    """
    cmp_struct = F.struct(*COMPARISON_COLUMNS[:-1], F.col("train_time_sec"))
    pc_struct = F.struct("model", "class_label", "precision", "recall", "f1", "support")
    cmp = comparison.select(
        cmp_struct.alias("c"), F.lit(None).cast(pc_struct_type(per_class)).alias("p"),
        "kind", "position", "f1_macro", F.lit(None).cast("double").alias("label_idx"),
    )
    pc = per_class.select(
        F.lit(None).cast(cmp_type(comparison)).alias("c"), pc_struct.alias("p"),
        F.lit(None).cast("string").alias("kind"), "position", F.lit(None).cast("double").alias("f1_macro"),
        "label_idx",
    )
    rank_key = F.struct(F.col("f1_macro"), (-F.col("position")).alias("neg_pos"))
    both = cmp.unionByName(pc)
    rec = both.agg(
        F.max_by(F.when(F.col("kind") == "single", F.col("c.model")),
                 F.when(F.col("kind") == "single", rank_key)).alias("best_single"),
        F.max_by(F.col("c.model"), F.when(F.col("c").isNotNull(), rank_key)).alias("best_overall"),
        F.sort_array(F.collect_list(F.when(F.col("c").isNotNull(), F.struct((-F.col("f1_macro")).alias("k"), "position", "c")))).alias("_cmp"),
        F.sort_array(F.collect_list(F.when(F.col("p").isNotNull(), F.struct("position", "label_idx", "p")))).alias("_pc"),
    )
    return rec.select(
        F.lit(_dt.datetime.now().isoformat()).alias("generated"),
        F.lit(dataset).alias("dataset"),
        F.lit(mode).alias("classification_mode"),
        F.lit(split).alias("split_mode"),
        F.array(*[F.lit(x) for x in train_files]).cast("array<string>").alias("train_files"),
        F.array(*[F.lit(x) for x in test_files]).cast("array<string>").alias("test_files"),
        "best_single",
        "best_overall",
        F.array(*[F.lit(m) for m in models]).cast("array<string>").alias("models"),
        F.array(*[F.struct(F.lit(m).alias("model"), F.lit(why).alias("reason")) for m, why in (skipped or {}).items()])
        .cast("array<struct<model:string,reason:string>>").alias("skipped"),
        *[F.lit((lines or {}).get(k)).cast("long").alias(f"{k}_lines") for k in ("accepted", "rejected")],
        F.transform("_cmp", lambda x: x["c"]).alias("comparison"),
        F.transform("_pc", lambda x: x["p"]).alias("per_class"),
    )


def cmp_type(comparison: DataFrame) -> StructType:
    fields = {f.name: f.dataType for f in comparison.schema.fields}
    return StructType([StructField(c, fields[c]) for c in COMPARISON_COLUMNS])


def pc_struct_type(per_class: DataFrame) -> StructType:
    fields = {f.name: f.dataType for f in per_class.schema.fields}
    return StructType([StructField(c, fields[c]) for c in ("model", "class_label", "precision", "recall", "f1", "support")])


def write_rejects(rejects: DataFrame, path: str) -> str:
    """JSON lines (source_file, record): input lines that were no rows, as they were read."""
    rejects.select("source_file", "record").write.mode("overwrite").json(path)
    return path


def write_experiment_json(record: DataFrame, path: str) -> str:
    record.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_report_tables(tables: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Each report table as its own CSV folder below ``path``."""
    return {name: _write_csv(df, f"{path.rstrip('/')}/{name}") for name, df in tables.items()}


EXPERIMENT_JSON_SCHEMA = StructType([
    StructField("generated", StringType()),
    StructField("dataset", StringType()),
    StructField("classification_mode", StringType()),
    StructField("split_mode", StringType()),
    StructField("train_files", ArrayType(StringType())),
    StructField("test_files", ArrayType(StringType())),
    StructField("best_single", StringType()),
    StructField("best_overall", StringType()),
    StructField("models", ArrayType(StringType())),
    StructField("skipped", ArrayType(StructType([StructField("model", StringType()), StructField("reason", StringType())]))),
    StructField("accepted_lines", LongType()),
    StructField("rejected_lines", LongType()),
    StructField("comparison", ArrayType(COMPARISON_SCHEMA)),
    StructField("per_class", ArrayType(PER_CLASS_SCHEMA)),
])
