"""A file stream of flows scored by a fitted experiment matches the batch confusion counts."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowguard.config import ExperimentConfig
from flowguard.plans.experiment import run_experiment
from flowguard.session import scratch_path
from flowguard.sources.tables import lineitem_flows
from flowguard.streaming.scoring import running_confusion, score_stream


def test_stream_scoring_matches_batch(spark):
    days = [f"day-{y}.csv" for y in range(1995, 2002)]
    cfg = ExperimentConfig(mode="multiclass", split="file", sample_fraction=1.0, train_sources=tuple(days[:5]),
                           test_sources=tuple(days[5:]), fast=True, class_weights=False)
    flows = lineitem_flows(spark, SF_SMALL).drop("l_orderkey", "l_linenumber")
    res = run_experiment(flows, cfg)

    # The test days arrive as a stream of parquet files.
    src = scratch_path(spark, "stream-in")
    flows.filter(F.col("source_file").isin(days[5:])).drop("source_file").repartition(3).write.parquet(src)
    stream = spark.readStream.schema(flows.drop("source_file").schema).option("maxFilesPerTrigger", 1).parquet(src)
    conf = running_confusion(score_stream(stream, res), res)
    q = conf.writeStream.outputMode("complete").format("memory").queryName("running_conf").start()
    try:
        q.processAllAvailable()
        got = {(r["model"], r["label_idx"], r["prediction"]): r["count"] for r in spark.table("running_conf").collect()}
    finally:
        q.stop()
    want = {(r["model"], r["label_idx"], r["prediction"]): r["count"] for r in res.confusion.collect()}
    assert got == want
    res.release()
