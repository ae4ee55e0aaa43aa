"""Ensembles over prediction columns of one scored frame: hard and soft voting.

The reference lines models up with one ``row_id`` join per model; here every model scored
the same frame (chained ``transform``), so the columns sit side by side and no join is needed.
``align_predictions`` is kept for users who score separately.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.functions.exprs import hard_vote_expr, qcol, soft_vote_probability_expr, vector_argmax_expr


def _as_array(df: DataFrame, col: str) -> Column:
    c = qcol(col)
    if isinstance(df.schema[col].dataType, VectorUDT):
        c = vector_to_array(c)
    return c.cast("array<double>")


def hard_vote(df: DataFrame, pred_cols: Sequence[str], output_col: str = "prediction") -> DataFrame:
    """Majority vote over prediction columns; tie -> smallest index; nulls ignored; all null -> null."""
    return df.withColumn(output_col, hard_vote_expr([qcol(c) for c in pred_cols]))


def soft_vote_probability(
    df: DataFrame, prob_cols: Sequence[str], output_col: str = "ensemble_probability",
) -> DataFrame:
    """Mean of probability vectors/arrays (zero-padded, nulls left out).

    Each vector becomes an array once per row: the mean reads it at every position, and as part of that
    expression it would be converted anew each time.
    """
    arrays = {f"__array_{i}": _as_array(df, c) for i, c in enumerate(prob_cols)}
    told = df.select("*", *[a.alias(n) for n, a in arrays.items()])
    return told.withColumn(output_col, soft_vote_probability_expr([F.col(n) for n in arrays])).drop(*arrays)


def vector_argmax(df: DataFrame, col: str, output_col: str = "prediction") -> DataFrame:
    """Index of the first maximum; null -> null."""
    return df.withColumn(output_col, vector_argmax_expr(_as_array(df, col)))


def soft_vote(
    df: DataFrame, prob_cols: Sequence[str], output_col: str = "prediction", prob_col: str = "ensemble_probability",
) -> DataFrame:
    """The class of the largest mean probability."""
    return soft_vote_probability(df, prob_cols, prob_col).withColumn(output_col, vector_argmax_expr(F.col(prob_col)))


def align_predictions(frames: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Inner equi-join of per-model prediction frames on a row key (shuffle join on the key)."""
    out = frames[0]
    for other in frames[1:]:
        out = out.join(other, on=key, how="inner")
    return out
