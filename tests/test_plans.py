"""Plan properties that matter at scale, checked on the physical plans (small data, same plans)."""

import contextlib
import io
import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()


def plan(spark, key: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[key](spark, SF_SMALL).explain("formatted")
    return buf.getvalue()


def nodes(text: str, name: str) -> int:
    return len(re.findall(rf"^\(\d+\) {name}\b", text, flags=re.M))


@pytest.mark.parametrize("key", ["hard_vote", "soft_vote", "clean_and_cast", "sanitize_features", "feature_pipeline",
                                 "split_by_hash", "trim_label"])
def test_row_level_queries_do_not_shuffle(spark, key):
    text = plan(spark, key)
    assert nodes(text, "Exchange") == 0 and nodes(text, "Sort") == 0, text


def test_scan_reads_only_needed_columns(spark):
    text = plan(spark, "hard_vote")
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in text


@pytest.mark.parametrize("key", ["compute_metrics", "hard_vote_per_class"])
def test_metrics_scan_events_once_and_shuffle_small_tables(spark, key):
    text = plan(spark, key)
    assert nodes(text, "Scan parquet") == 1
    assert nodes(text, "Exchange") <= 3  # confusion counts, per-class, per-model
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("key", ["add_class_weights", "weight_lookup"])
def test_class_tables_travel_as_literals(spark, key):
    """No join but that of documents and labels, which makes the flows."""
    text = plan(spark, key)
    assert "BroadcastNestedLoopJoin" not in text
    assert nodes(text, "BroadcastHashJoin") + nodes(text, "SortMergeJoin") <= 1


def test_headers_are_read_without_jobs(spark):
    """However many capture files there are, only their distinct header lines cost a job each."""
    from flowguard.session import scratch_path
    from flowguard.sources import flow_csv

    base = scratch_path(spark, "many")
    days = spark.range(30).select(F.col("id").alias("x"), F.lit("l").alias("y"), F.concat(F.lit("d"), "id").alias("day"))
    flow_csv.write_flow_csv(days, base, [" A", " Label"], partition_by=["day"])
    paths = flow_csv.list_folders(spark, base)
    jobs = []
    for n in (3, 30):
        spark.sparkContext.setJobGroup(f"headers-{n}", "")
        flow_csv.read_headers(spark, paths[:n])
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers-{n}")))
    spark.sparkContext._jsc.clearJobGroup()
    assert jobs[0] == jobs[1] <= 1


def test_capture_days_read_by_one_scan_per_header_layout(spark):
    text = plan(spark, "read_flow_csvs")
    assert nodes(text, "Scan csv") == 2  # 7 day folders, 2 header layouts


def test_no_cross_joins_anywhere(spark):
    for key in ["chart_ensemble_gain", "chart_confusion_dense", "report_tables", "align_predictions"]:
        text = plan(spark, key)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, key
