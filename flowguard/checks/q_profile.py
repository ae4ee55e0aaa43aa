"""Profiling, splits and class weights over lineitem / events / documents stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowguard.catalog import register
from flowguard.operators import profile, split, weights
from flowguard.operators.clean import source_in as source_in_op
from flowguard.sources.tables import document_flows, event_flows, lineitem_flows, table

LI_SOURCE = "'day-' || CAST(year(l_shipdate) AS VARCHAR) || '.csv'"
TRAIN_DAYS = [f"day-{y}.csv" for y in range(1995, 2000)]
TEST_DAYS = [f"day-{y}.csv" for y in range(2000, 2002)]
PCT = "round(CAST(count(*) AS DOUBLE) * 100.0::DOUBLE / sum(count(*)) OVER (), 4)"


@register("label_distribution", f"""
SELECT l_returnflag AS label, count(*) AS count, {PCT} AS percent FROM lineitem GROUP BY l_returnflag""")
def label_distribution(spark, sf_dir):
    return profile.label_distribution(lineitem_flows(spark, sf_dir), "label")


@register("rows_per_source", f"""
SELECT {LI_SOURCE} AS source_file, count(*) AS count, {PCT} AS percent FROM lineitem GROUP BY 1""")
def rows_per_source(spark, sf_dir):
    return profile.rows_per_source(lineitem_flows(spark, sf_dir), "source_file")


@register("dataset_summary", """
SELECT count(*) AS total_rows, 4 AS feature_columns FROM lineitem""")
def dataset_summary(spark, sf_dir):
    flows = lineitem_flows(spark, sf_dir).drop("l_orderkey", "l_linenumber")
    return profile.dataset_summary(flows)


@register("split_summary", f"""
SELECT split, count(*) AS count, {PCT} AS percent FROM (
  SELECT CASE WHEN year(l_shipdate) <= 1999 THEN 'train' ELSE 'test' END AS split FROM lineitem) t
GROUP BY split""")
def split_summary(spark, sf_dir):
    train, test = split.split_by_source(lineitem_flows(spark, sf_dir), TRAIN_DAYS, TEST_DAYS)
    return profile.split_summary(train, test)


@register("count_dataset", f"""
SELECT label, count(*) AS count, {PCT} AS percent, CAST(sum(count(*)) OVER () AS BIGINT) AS total_rows FROM (
  SELECT CASE WHEN upper(trim(l_returnflag)) = 'N' THEN 'normal' ELSE 'attack' END AS label FROM lineitem) t
GROUP BY label""")
def count_dataset(spark, sf_dir):
    flows = lineitem_flows(spark, sf_dir).drop("l_orderkey", "l_linenumber")
    return profile.count_dataset(flows, mode="binary", normal_label="N")


@register("class_weights", """
SELECT CAST(quality AS VARCHAR) AS label, count(*) AS count,
       sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
FROM documents JOIN labels USING (doc_id) GROUP BY quality""")
def class_weights(spark, sf_dir):
    return weights.class_weights(document_flows(spark, sf_dir), "label")


@register("class_weights_by_source", """
SELECT source, CAST(quality AS VARCHAR) AS label, count(*) AS count,
       sum(count(*)) OVER (PARTITION BY source) / (count(*) OVER (PARTITION BY source) * count(*)) AS weight
FROM documents JOIN labels USING (doc_id) GROUP BY source, quality""")
def class_weights_by_source(spark, sf_dir):
    flows = document_flows(spark, sf_dir).withColumnRenamed("source_file", "source")
    return weights.class_weights(flows, "label", by=["source"])


@register("add_class_weights", """
WITH w AS (
  SELECT quality, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
  FROM documents JOIN labels USING (doc_id) GROUP BY quality)
SELECT d.doc_id, CAST(l.quality AS VARCHAR) AS label, w.weight
FROM documents d JOIN labels l ON d.doc_id = l.doc_id JOIN w ON l.quality = w.quality""")
def add_class_weights(spark, sf_dir):
    flows = document_flows(spark, sf_dir)
    return weights.add_class_weights(flows, "label").select("doc_id", "label", "weight")


SPLIT_ROWS = f"""
SELECT CASE WHEN year(l_shipdate) <= 1999 THEN 'train' ELSE 'test' END AS split,
       l_orderkey, l_linenumber, l_quantity, l_returnflag AS label FROM lineitem
WHERE {LI_SOURCE} IN ({", ".join(f"'{d}'" for d in TRAIN_DAYS + TEST_DAYS)})"""


@register("split_by_source", SPLIT_ROWS)
def split_by_source(spark, sf_dir):
    flows = lineitem_flows(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "label", "source_file")
    train, test = split.split_by_source(flows, TRAIN_DAYS, TEST_DAYS)
    return split.tag_splits(train, test).select("split", "l_orderkey", "l_linenumber", "l_quantity", "label")


@register("split_dispatch", SPLIT_ROWS + """
UNION ALL SELECT 'error', NULL, NULL, NULL, unnest(['file', 'hash', 'other'])""")
def split_dispatch(spark, sf_dir):
    """Dispatch to the file split; splits without what they need are errors, never another split."""
    flows = lineitem_flows(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "label", "source_file")
    refused = []
    for kind in ("file", "hash", "random", "other"):
        try:
            split.split_dispatch(flows.limit(0), kind)
        except ValueError:
            refused.append((kind,))
    train, test = split.split_dispatch(flows, "file", TRAIN_DAYS, TEST_DAYS)
    out = split.tag_splits(train, test).select("split", "l_orderkey", "l_linenumber", "l_quantity", "label")
    errors = spark.createDataFrame(refused, "label string").withColumn("split", F.lit("error"))
    return out.unionByName(errors, allowMissingColumns=True)


@register("split_by_hash", """
SELECT CASE WHEN ('0x' || substr(md5(coalesce(CAST(k AS VARCHAR), '') || ':42'), 1, 8))::BIGINT % 10000 < 8000
            THEN 'train' ELSE 'test' END AS split, event_id, event_type AS label
FROM (SELECT *, CASE WHEN event_id % 20 <> 3 THEN event_id END AS k FROM events) e""")
def split_by_hash(spark, sf_dir):
    """Every row is in one part, those with a null key (every 20th) together."""
    flows = event_flows(spark, sf_dir).select("event_id", "label", "source_file", F.expr("CASE WHEN event_id % 20 <> 3 THEN event_id END").alias("k"))
    train, test = split.split_by_hash(flows, ["k"], 0.8, 42)
    return split.tag_splits(train, test).select("split", "event_id", "label")


@register("split_random", """
SELECT label, user_id, CASE WHEN ('0x' || substr(md5(label || '|' || user_id || '|' || (k - 1) || ':42'), 1, 8))::BIGINT < 3435973836
  THEN 'train' ELSE 'test' END AS split, count(*) AS rows
FROM (SELECT event_type AS label, user_id, row_number() OVER (PARTITION BY event_type, user_id) AS k FROM events) t GROUP BY ALL""")
def split_random(spark, sf_dir):
    """The split itself, of rows that repeat: how many of each kind are in which part."""
    flows = table(spark, sf_dir, "events").select(F.col("event_type").alias("label"), "user_id")
    train, test = split.split_random(flows, 0.8, 42)
    return split.tag_splits(train, test).groupBy("label", "user_id", "split").agg(F.count(F.lit(1)).alias("rows"))


@register("sample_rows_fraction", """
SELECT l_orderkey, l_linenumber, label, split FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, label, split) - 1 AS k
  FROM (SELECT l_orderkey, l_linenumber, l_returnflag AS label, CASE WHEN year(l_shipdate) <= 1999 THEN 'train' ELSE 'test' END AS split FROM lineitem) u) t
WHERE split = 'test' OR ('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|' || label || '|' || k || ':42'), 1, 8))::BIGINT < 1288490188""")
def sample_rows_fraction(spark, sf_dir):
    """Sampling after the split: the very rows of 30 % of the training part, and the test rows whole."""
    flows = lineitem_flows(spark, sf_dir).select("l_orderkey", "l_linenumber", "label", "source_file")
    train, test = split.split_by_source(flows, TRAIN_DAYS, TEST_DAYS)
    return split.tag_splits(*split.sample_splits(train, test, 0.3, 42)).select("l_orderkey", "l_linenumber", "label", "split")


@register("source_in", f"""
SELECT l_orderkey, l_linenumber, l_returnflag AS label, {LI_SOURCE} AS source_file FROM lineitem
WHERE {LI_SOURCE} IN ('day-1996.csv', 'day-1998.csv')""")
def source_in(spark, sf_dir):
    flows = lineitem_flows(spark, sf_dir).select("l_orderkey", "l_linenumber", "label", "source_file")
    return source_in_op(flows, ["day-1996.csv", "day-1998.csv"])


@register("union_by_name", """
SELECT l_orderkey, l_linenumber, l_quantity, l_tax, l_returnflag AS label FROM lineitem WHERE year(l_shipdate) <= 1997
UNION ALL BY NAME
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag AS label FROM lineitem WHERE year(l_shipdate) > 1997""")
def union_by_name(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    early = li.filter(F.year("l_shipdate") <= 1997).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", F.col("l_returnflag").alias("label"))
    late = li.filter(F.year("l_shipdate") > 1997).select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_returnflag").alias("label"))
    return early.unionByName(late, allowMissingColumns=True)


@register("weight_lookup", """
WITH w AS (
  SELECT quality, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
  FROM documents JOIN labels USING (doc_id) GROUP BY quality)
SELECT d.doc_id, CASE WHEN l.quality = 0 THEN 1.0::DOUBLE ELSE w.weight END AS weight
FROM documents d JOIN labels l ON d.doc_id = l.doc_id JOIN w ON l.quality = w.quality""")
def weight_lookup(spark, sf_dir):
    """A given class table mapped back to the rows; a class that it lacks weighs 1."""
    flows = document_flows(spark, sf_dir)
    table_ = weights.class_weights(flows, "label")
    return weights.add_class_weights(flows, "label", weights=table_.filter("label <> '0'")).select("doc_id", "weight")
