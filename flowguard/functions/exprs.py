"""Native column expressions for cleaning, sanitising, voting and naming.

These replace row-at-a-time Python functions. Hard votes are unrolled over the voters into
scalar expressions, which whole-stage codegen compiles; vectors, whose lengths are only known
at run time, go through Spark's higher-order functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

from flowguard.config import UNKNOWN_LABEL

# A raw cell counts as a number only when it starts like one.
NUMERIC_PREFIX = r"^\s*-?[0-9]"
INF = float("inf")


def qcol(name: str) -> Column:
    """Column by exact name (names from CSV headers may hold spaces, dots or slashes)."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_value(c: Column, dtype: DataType | None = None) -> Column:
    """Lenient text-to-double: a cell that starts like a number is cast, anything else is 0.0.

    ``try_cast`` instead of ``cast`` keeps this safe under ANSI mode (Spark 4's default):
    ``12abc`` passes the prefix test but fails the cast, and becomes 0.0 instead of an error.
    ``inf``/``NaN``/``Infinity`` fail the prefix test -> 0.0; ``1e999`` passes and stays
    +Infinity (sanitising zeroes it later). Typed numeric input skips the text round trip.
    """
    if isinstance(dtype, NumericType):
        d = c.cast("double")
        return F.when(F.isnan(d) | (F.abs(d) == F.lit(INF)), F.lit(0.0)).otherwise(F.coalesce(d, F.lit(0.0)))
    s = c if isinstance(dtype, StringType) else c.cast("string")
    return F.coalesce(F.when(s.rlike(NUMERIC_PREFIX), s.try_cast("double")), F.lit(0.0))


def sanitize_value(c: Column) -> Column:
    """NaN, +-Infinity and negatives -> 0.0; ``-0.0`` -> ``0.0`` (adding +0.0 normalises the sign)."""
    d = c.cast("double")
    return F.when(F.isnan(d) | (d < 0) | (d == F.lit(INF)), F.lit(0.0)).otherwise(d + F.lit(0.0))


def sanitize_array_expr(c: Column) -> Column:
    """Element-wise ``sanitize_value`` on an array; a null array becomes ``[0.0]``."""
    return F.when(c.isNull(), F.array(F.lit(0.0))).otherwise(F.transform(c, sanitize_value))


def hard_vote_expr(vote_cols: Sequence[Column]) -> Column:
    """Majority vote; a tie goes to the smallest class index; null votes are ignored.

    Unrolled over the (plan-time known) voters so it stays in whole-stage codegen: voter i
    becomes the struct (number of voters agreeing with i, -vote_i), null when it abstains;
    ``greatest`` skips nulls and picks the most frequent vote, the smallest among equals.
    All-null -> null.
    """
    votes = [v.cast("double") for v in vote_cols]
    cands = []
    for v in votes:
        agree = sum((F.when(w == v, F.lit(1)).otherwise(F.lit(0)) for w in votes), F.lit(0))
        cands.append(F.when(v.isNotNull() & ~F.isnan(v), F.struct(agree.alias("n"), (-v).alias("neg"))))
    best = cands[0] if len(cands) == 1 else F.greatest(*cands)
    return -(best.getField("neg"))


def soft_vote_probability_expr(prob_cols: Sequence[Column]) -> Column:
    """Element-wise mean of probability arrays of any lengths.

    Shorter arrays are zero-padded to the longest; null arrays are left out of the mean;
    all null -> null. Each position is one sum over the voters in column order, so the
    expression grows linearly with their number, whatever the lengths.
    """
    arrays = [p.cast("array<double>") for p in prob_cols]
    n = sum((F.when(a.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for a in arrays), F.lit(0))
    sizes = [F.size(F.coalesce(a, F.array().cast("array<double>"))) for a in arrays]
    longest = sizes[0] if len(sizes) == 1 else F.greatest(*sizes)
    mean = F.transform(
        F.sequence(F.lit(0), longest - 1),
        lambda i: sum((F.coalesce(F.get(a, i), F.lit(0.0)) for a in arrays), F.lit(0.0)) / n,
    )
    return (
        F.when(n == 0, F.lit(None).cast("array<double>"))
        .when(longest == 0, F.array().cast("array<double>"))
        .otherwise(mean)
    )


def vector_argmax_expr(c: Column) -> Column:
    """Index of the first maximum of an array, as double; null -> null."""
    return (F.array_position(c, F.array_max(c)) - 1).cast("double")


def label_name_expr(idx: Column, labels: Sequence[str]) -> Column:
    """Class index -> name. Index n (StringIndexer 'keep' bucket) -> ``__unknown``; beyond -> the index."""
    names = F.array(*[F.lit(x) for x in list(labels) + [UNKNOWN_LABEL]])
    i = idx.cast("int")
    return F.when(idx.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.get(names, i), i.cast("string"))
    )


def label_index_expr(label: Column, labels: Sequence[str]) -> Column:
    """Label -> index by a fitted label list (StringIndexer 'keep' semantics: unseen or null -> n).

    The list has one entry per class, so it travels as a literal map: no join, no shuffle.
    """
    if not labels:
        return F.lit(0.0)
    lookup = F.create_map(*[x for i, name in enumerate(labels) for x in (F.lit(name), F.lit(float(i)))])
    return F.coalesce(F.element_at(lookup, label), F.lit(float(len(labels))))


def pretty_model_name_expr(c: Column) -> Column:
    """``naive_bayes`` -> ``Naive Bayes``: underscores to spaces, each word capitalised."""
    words = F.split(F.regexp_replace(c, "_", " "), " ")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))),
        " ",
    )
