"""Feature preparation: label/category indexing, sanitising stage, assembler, pipeline.

The reference sanitises assembled vectors with a Python UDF. Here sanitising is a
``SQLTransformer`` stage over the scalar columns *before* the assembler, so it is a native
projection and the whole pipeline stays in the JVM. Row-dropping semantics are kept: rows
with a null or NaN feature are dropped (the reference's assembler ``skip``), then NaN,
+-Infinity and negatives become 0.0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.exprs import label_name_expr, qcol
from flowguard.operators.categories import CategoryIndex, fit_category_index


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: A label column with more values than this isn't one; class tables are refused beyond it.
MAX_CLASSES = 10_000


def class_rows(table: DataFrame) -> list:
    """The rows of a table with one row per class, on the driver; more than ``MAX_CLASSES`` are an error."""
    rows = table.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes: not a label column")
    return rows


def label_counts(df: DataFrame, label_col: str = "label") -> list[tuple[str, int]]:
    """(label, count) in StringIndexer order (count desc, then label): one aggregation, one row per class."""
    counts = df.groupBy(qcol(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    rows = class_rows(counts.filter(F.col("label").isNotNull()))
    # Sorted here, not by a global sort job: UTF-8 byte order equals Python's code-point order.
    return sorted(((r["label"], int(r["n"])) for r in rows), key=lambda x: (-x[1], x[0]))


def label_indexer_from(labels: Sequence[str], label_col: str = "label", output_col: str = "label_idx") -> StringIndexerModel:
    """A fitted label indexer from a known label list (no pass over the data)."""
    return StringIndexerModel.from_labels(list(labels), inputCol=label_col, outputCol=output_col, handleInvalid="keep")


def fit_label_indexer(df: DataFrame, label_col: str = "label", output_col: str = "label_idx") -> StringIndexerModel:
    """StringIndexer (frequency order, unseen and null -> index n)."""
    return StringIndexer(inputCol=label_col, outputCol=output_col, handleInvalid="keep").fit(df)


def index_labels(df: DataFrame, label_col: str = "label", output_col: str = "label_idx") -> tuple[DataFrame, list[str]]:
    """Index ``label_col``; returns the indexed frame and the label list (index order)."""
    model = fit_label_indexer(df, label_col, output_col)
    return model.transform(df), list(model.labels)


def index_categories(df: DataFrame, columns: Sequence[str], suffix: str = "_idx") -> tuple[DataFrame, CategoryIndex]:
    """Index several columns by frequency; returns the indexed frame and the fitted index, a table (``categories``).

    For columns with any number of values; the values never reach the driver, so the indices carry no names as metadata.
    """
    index = fit_category_index(df, columns)
    return index.transform(df, suffix), index


def index_to_label(df: DataFrame, idx_col: str, labels: Sequence[str], output_col: str) -> DataFrame:
    """Index -> name; index n -> ``__unknown`` (``IndexToString`` would raise on it)."""
    return df.withColumn(output_col, label_name_expr(qcol(idx_col), labels))


def sanitize_stage(feature_cols: Sequence[str], passthrough: Sequence[str] = (), prefix: str = "__f") -> tuple[SQLTransformer, list[str]]:
    """SQL stage: drop rows with null/NaN features, then NaN/inf/negative -> 0.0 and -0.0 -> 0.0.

    ``passthrough`` columns (categorical indices with nominal metadata) go to the assembler
    untouched. Returns the stage and the assembler input names.
    """
    outs, selects = [], []
    for i, c in enumerate(feature_cols):
        q = _q(c)
        out = f"{prefix}{i}"
        selects.append(
            f"CASE WHEN {q} < 0 OR {q} = double('inf') THEN 0.0D ELSE CAST({q} AS DOUBLE) + 0.0D END AS {_q(out)}"
        )
        outs.append(out)
    # Row filter in two codegen-able predicates: a sum is null iff some value is null, and
    # ``greatest`` orders NaN above every number, so it is NaN iff some value is NaN.
    values = [f"CAST({_q(c)} AS DOUBLE)" for c in feature_cols]
    if not values:
        where = "true"
    else:
        top = values[0] if len(values) == 1 else f"greatest({', '.join(values)})"
        where = f"({' + '.join(values)}) IS NOT NULL AND NOT isnan({top})"
    statement = f"SELECT *, {', '.join(selects)} FROM __THIS__ WHERE {where}" if selects else "SELECT * FROM __THIS__"
    return SQLTransformer(statement=statement), [*passthrough, *outs]


def feature_pipeline(
    feature_cols: Sequence[str],
    categorical_cols: Sequence[str] = (),
    label_col: str = "label",
    keep_categorical_metadata: bool = False,
    labels: Sequence[str] | None = None,
) -> Pipeline:
    """Unfitted pipeline: category indexers, label indexer, sanitising stage, assembler (no scaler).

    Fit it on the training part only. With ``keep_categorical_metadata`` the category indices
    reach the assembler with their nominal metadata (trees then need ``maxBins`` >= the largest
    number of categories); by default they pass through the sanitising expression, which drops
    the metadata, so trees treat them as continuous, as in the reference. With ``labels``
    (e.g. from ``label_counts``) the label stage is pre-fitted and costs no pass at fit time.
    """
    stages = []
    cat_idx = [f"{c}_idx" for c in categorical_cols]
    if categorical_cols:
        stages.append(StringIndexer(inputCols=list(categorical_cols), outputCols=cat_idx, handleInvalid="keep"))
    if labels is not None:
        stages.append(label_indexer_from(labels, label_col))
    else:
        stages.append(StringIndexer(inputCol=label_col, outputCol="label_idx", handleInvalid="keep"))
    numeric = [c for c in feature_cols if c not in set(categorical_cols)]
    if keep_categorical_metadata:
        sanitizer, inputs = sanitize_stage(numeric, passthrough=cat_idx)
    else:
        sanitizer, inputs = sanitize_stage([*cat_idx, *numeric])
    stages.append(sanitizer)
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip"))
    return Pipeline(stages=stages)


def fitted_label_names(prep_model, label_col: str = "label") -> list[str]:
    """Label list of the fitted label indexer (matches ``StringIndexerModel``, not the estimator)."""
    for stage in prep_model.stages:
        if isinstance(stage, StringIndexerModel) and stage.getOrDefault("outputCol") == "label_idx":
            return list(stage.labels)
    return []


def assemble_features(df: DataFrame, feature_cols: Sequence[str], output_col: str = "features") -> DataFrame:
    """All feature columns -> one vector; rows with a null/NaN feature are dropped (``skip``)."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=output_col, handleInvalid="skip").transform(df)


def with_row_id(df: DataFrame, output_col: str = "row_id") -> DataFrame:
    """Unique (not consecutive) 64-bit id per row; stable only while the input layout is."""
    return df.withColumn(output_col, F.monotonically_increasing_id())
