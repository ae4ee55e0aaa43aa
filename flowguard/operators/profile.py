"""Profiling aggregations: totals, rows per source, label distribution, split summary.

Each is a single grouped aggregation over the whole table (partial aggregation on the map
side, so a label holding most rows costs no more than any other). Percentages divide by a scalar
subquery over the aggregated rows (with ``by``, by a total per group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.exprs import qcol
from flowguard.operators.clean import drop_incomplete, feature_columns
from flowguard.operators.labels import prepare_labels


def _with_percent(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    if by:  # a total per group, joined on the group
        totals = counts.groupBy(*[qcol(b).alias(f"__{b}") for b in by]).agg(F.sum("count").alias("__total"))
        counts = counts.join(totals, [F.col(f"__{b}").eqNullSafe(qcol(b)) for b in by])
        total = F.col("__total")
    else:
        total = counts.agg(F.sum("count")).scalar()
    pct = F.when(total > 0, F.round(F.col("count") * 100.0 / total, 4)).otherwise(F.lit(0.0))
    return counts.withColumn("percent", pct).drop("__total", *[f"__{b}" for b in by])


def dataset_summary(df: DataFrame, label_col: str = "label", source_col: str = "source_file") -> DataFrame:
    """One row: total rows and number of feature columns."""
    n_features = len(feature_columns(df, (label_col, source_col)))
    return df.agg(F.count(F.lit(1)).alias("total_rows")).withColumn("feature_columns", F.lit(n_features))


def rows_per_source(df: DataFrame, source_col: str = "source_file", by: Sequence[str] = ()) -> DataFrame:
    """Count and percent per source, ordered by name."""
    counts = df.groupBy(*by, qcol(source_col).alias(source_col)).agg(F.count(F.lit(1)).alias("count"))
    return _with_percent(counts, by).orderBy(*by, source_col)


def label_distribution(df: DataFrame, label_col: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Count and percent (4 decimals) per label, by count desc then label."""
    return distribution_of(df.groupBy(*by, qcol(label_col).alias("label")).agg(F.count(F.lit(1)).alias("count")), by)


def distribution_of(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The label distribution of known (label, count) rows."""
    return _with_percent(counts, by).orderBy(*by, F.desc("count"), "label")


def split_summary(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows and percent of total for the train and test parts (one pass over each)."""
    parts = train.select(F.lit("train").alias("split")).unionByName(test.select(F.lit("test").alias("split")))
    counts = parts.groupBy("split").agg(F.count(F.lit(1)).alias("count"))
    return _with_percent(counts).orderBy(F.desc("split"))


def count_dataset(
    df: DataFrame, mode: str = "multiclass", normal_label: str = "BENIGN", label_col: str = "label"
) -> DataFrame:
    """Loaded data -> dropna -> label preparation -> label distribution with the total (no training)."""
    prepared = prepare_labels(drop_incomplete(df), mode, normal_label, label_col)
    dist = label_distribution(prepared, label_col)
    return dist.withColumn("total_rows", dist.agg(F.sum("count")).scalar())
