"""Column expressions shared by the operators. All are native Spark expressions."""

from flowguard.functions.exprs import (
    clean_value,
    hard_vote_expr,
    label_index_expr,
    label_name_expr,
    pretty_model_name_expr,
    qcol,
    sanitize_array_expr,
    sanitize_value,
    soft_vote_probability_expr,
    vector_argmax_expr,
)

__all__ = [
    "clean_value",
    "hard_vote_expr",
    "label_index_expr",
    "label_name_expr",
    "pretty_model_name_expr",
    "qcol",
    "sanitize_array_expr",
    "sanitize_value",
    "soft_vote_probability_expr",
    "vector_argmax_expr",
]
