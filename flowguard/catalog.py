"""Registered queries over the test tables, each with an equivalent DuckDB SQL oracle.

``QUERIES[key](spark, sf_dir) -> DataFrame`` runs an operator over whole tables (stand-ins
of FIXTURES.md section 5); ``ORACLES[key]`` is SQL over the same tables. Keys without an
oracle (seeded sampling, MLlib models other than naive Bayes) get a rows-only check.
Floating sums whose order differs between engines are rounded to 9 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
R = 9  # decimals for order-dependent floating sums


def register(key: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return wrap


# Load the query modules (each registers itself).
from flowguard.checks import (  # noqa: E402,F401
    q_clean,
    q_ml,
    q_profile,
    q_reports,
    q_sources,
    q_votes,
)
