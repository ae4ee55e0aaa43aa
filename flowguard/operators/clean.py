"""Cleaning and projection operators. Each is one ``select`` or ``filter``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.config import LABEL_CANDIDATES
from flowguard.functions.exprs import clean_value, qcol, sanitize_array_expr, sanitize_value


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip leading/trailing whitespace from every column name (one projection)."""
    return df.toDF(*[c.strip() for c in df.columns])


def normalize_label_column(df: DataFrame, label_col: str = "label") -> DataFrame:
    """The label column under its canonical name; an exact name wins, then a known variant, else ``ValueError``."""
    found = next((name for name in (label_col, *LABEL_CANDIDATES) if name in df.columns), None)
    if found is None:
        raise ValueError(f"none of {[label_col, *LABEL_CANDIDATES]} is among the {len(df.columns)} columns: {', '.join(df.columns)}")
    return df if found == label_col else df.withColumnRenamed(found, label_col)


def feature_columns(df: DataFrame, skip: Iterable[str] = ("label", "source_file")) -> list[str]:
    """Every column that is not the label or the source tag."""
    skip = set(skip)
    return [c for c in df.columns if c not in skip]


def clean_and_cast(df: DataFrame, skip: Iterable[str] = ("label", "source_file")) -> DataFrame:
    """All feature columns -> double in ONE select (lenient: unparsable, inf, NaN, null -> 0.0)."""
    skip = set(skip)
    fields = {f.name: f.dataType for f in df.schema.fields}
    return df.select([qcol(c) if c in skip else clean_value(qcol(c), fields[c]).alias(c) for c in df.columns])


def cast_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Plain numeric cast of the given columns (KDD); failures become null (``try_cast``), in one select."""
    cols = set(columns)
    return df.select([qcol(c).try_cast("double").alias(c) if c in cols else qcol(c) for c in df.columns])


def strip_label_dot(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``normal.`` -> ``normal``."""
    return df.withColumn(label_col, F.regexp_replace(qcol(label_col), r"\.$", ""))


def drop_header_rows(df: DataFrame, first_col: str, header_name: str) -> DataFrame:
    """Drop rows whose first cell equals the (trimmed) first header name.

    Spark's CSV writer repeats the header in every part file, so a multi-part folder has
    many such rows. A row with a blank first cell is data and stays.
    """
    return df.filter(~F.trim(qcol(first_col)).eqNullSafe(F.lit(header_name.strip())))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of ``subset`` (default: all columns)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def source_in(df: DataFrame, sources: Sequence[str], source_col: str = "source_file") -> DataFrame:
    """Rows whose source tag is one of ``sources``."""
    return df.filter(qcol(source_col).isin(list(sources)))


def sanitize_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN, +-Infinity, negatives -> 0.0 and -0.0 -> 0.0 on scalar feature columns, in one select."""
    cols = set(columns)
    return df.select([sanitize_value(qcol(c)).alias(c) if c in cols else qcol(c) for c in df.columns])


def sanitize_vector(df: DataFrame, col: str) -> DataFrame:
    """Same rule element-wise on an array (or ML vector) column; null -> ``[0.0]``."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT

    c = qcol(col)
    if isinstance(df.schema[col].dataType, VectorUDT):
        c = vector_to_array(c)
    return df.withColumn(col, sanitize_array_expr(c.cast("array<double>")))
