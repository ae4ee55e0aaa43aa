"""flowguard: labelled network-flow analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (usable with ``df.transform``)
built from native Spark SQL expressions, so Catalyst can push filters and projections
into the scan and whole-stage codegen covers the per-row work.

Sub-packages
------------
sources    CSV flow readers (CIC-style headers, KDD fixed schema), path profiles
functions  Column expressions: lenient cleaning, sanitising, votes, index lookups
operators  Relational and ML steps: labels, profiling, splits, weights, features,
           models, ensembles, metrics, ranking
plans      Experiment orchestration, report tables, chart-data tables
sinks      CSV / JSON writers for result tables
streaming  Scoring of flow streams with a fitted experiment
"""

from flowguard.config import ExperimentConfig

__all__ = ["ExperimentConfig"]
__version__ = "0.1.0"
