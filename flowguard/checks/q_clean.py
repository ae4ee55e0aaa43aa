"""Cleaning, casting, label and sanitising queries. Dirty values are made by CASE on both sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowguard.catalog import register
from flowguard.operators import clean, labels
from flowguard.sources.tables import table

# Dirty raw text. Only values where Spark and DuckDB parse alike (not 1d, 1f, 1_000).
DIRTY_Q = """CASE (l_orderkey + l_linenumber) % 12
  WHEN 0 THEN ' 12' WHEN 1 THEN '12 ' WHEN 2 THEN '-3.5' WHEN 3 THEN '1e5' WHEN 4 THEN 'inf'
  WHEN 5 THEN 'NaN' WHEN 6 THEN '' WHEN 7 THEN 'abc' WHEN 8 THEN '+5' WHEN 9 THEN '12abc'
  WHEN 10 THEN NULL ELSE CAST(l_quantity AS STRING) END"""
DIRTY_D = """CASE (l_orderkey * 7 + l_linenumber) % 9
  WHEN 0 THEN '-Infinity' WHEN 1 THEN '.5' WHEN 2 THEN '0x10' WHEN 3 THEN 'Infinity' WHEN 4 THEN '-inf'
  WHEN 5 THEN 'INF' WHEN 6 THEN '  -7.25  ' WHEN 7 THEN '0012' ELSE CAST(l_discount AS STRING) END"""
# For plain casts (failures -> null): no NaN text, so results never hold NaN.
DIRTY_K = """CASE (l_orderkey + l_linenumber) % 10
  WHEN 0 THEN ' 12' WHEN 1 THEN '-3.5' WHEN 2 THEN '1e5' WHEN 3 THEN 'abc' WHEN 4 THEN ''
  WHEN 5 THEN '+5' WHEN 6 THEN '12abc' WHEN 7 THEN '1.5e-3' ELSE CAST(l_extendedprice AS STRING) END"""
CLEAN_SQL = "coalesce(CASE WHEN regexp_matches({x}, '^\\s*-?[0-9]') THEN try_cast({x} AS DOUBLE) END, 0.0::DOUBLE)"
SANITIZE_SQL = "CASE WHEN isnan({x}) OR {x} <= 0 OR {x} = CAST('Infinity' AS DOUBLE) THEN 0.0::DOUBLE ELSE {x} END"


@register("clean_and_cast", f"""
SELECT l_orderkey, l_linenumber, {CLEAN_SQL.format(x='q')} AS quantity, {CLEAN_SQL.format(x='d')} AS discount,
       l_returnflag AS label
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, {DIRTY_Q} AS q, {DIRTY_D} AS d FROM lineitem) t""")
def clean_and_cast(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(DIRTY_Q).alias("quantity"), F.expr(DIRTY_D).alias("discount"),
        F.col("l_returnflag").alias("label"),
    )
    return clean.clean_and_cast(raw, skip=("l_orderkey", "l_linenumber", "label"))


@register("cast_kdd_numeric", f"""
SELECT l_orderkey, l_linenumber, try_cast(k AS DOUBLE) AS price, try_cast(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS qty
FROM (SELECT *, {DIRTY_K} AS k FROM lineitem) t""")
def cast_kdd_numeric(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(DIRTY_K).alias("price"), F.col("l_quantity").cast("string").alias("qty"),
    )
    return clean.cast_numeric(raw, ["price", "qty"])


DOTTED = "CASE event_id % 3 WHEN 0 THEN event_type || '.' WHEN 1 THEN event_type ELSE event_type || '..' END"


@register("strip_label_dot", f"""
SELECT event_id, regexp_replace({DOTTED}, '\\.$', '') AS label FROM events""")
def strip_label_dot(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", F.expr(DOTTED).alias("label"))
    return clean.strip_label_dot(raw, "label")


PADDED = """CASE event_id % 4 WHEN 0 THEN '  ' || event_type WHEN 1 THEN event_type || '   '
  WHEN 2 THEN ' ' || event_type || ' ' ELSE event_type END"""
CASED = """CASE event_id % 4 WHEN 0 THEN upper(event_type) WHEN 1 THEN event_type
  WHEN 2 THEN upper(substr(event_type, 1, 1)) || substr(event_type, 2) ELSE ' ' || lower(event_type) END"""


@register("trim_label", f"SELECT event_id, trim({PADDED}) AS label FROM events")
def trim_label(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", F.expr(PADDED).alias("label"))
    return labels.trim_label(raw, "label")


@register("binary_label", f"""
SELECT event_id, CASE WHEN upper({CASED}) = 'VIEW' THEN 'normal' ELSE 'attack' END AS label FROM events""")
def binary_label(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", F.expr(CASED).alias("label"))
    return labels.binary_label(raw, "view", "label")


@register("prepare_labels", f"""
SELECT event_id, CASE WHEN upper(trim({CASED})) = 'VIEW' THEN 'normal' ELSE 'attack' END AS label FROM events""")
def prepare_labels(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", F.expr(CASED).alias("label"))
    return labels.prepare_labels(raw, "binary", "view", "label")


@register("prepare_labels_multiclass", f"SELECT event_id, trim({PADDED}) AS label FROM events")
def prepare_labels_multiclass(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", F.expr(PADDED).alias("label"))
    return labels.prepare_labels(raw, "multiclass", "view", "label")


@register("normalize_label_column", """
SELECT l_orderkey, l_linenumber, l_returnflag AS label FROM lineitem""")
def normalize_label_column(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias(" Label"))
    return clean.normalize_label_column(raw, "label")


HOLES_V = "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END"
HOLES_U = "CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END"


@register("drop_incomplete", f"""
SELECT event_id, value, user_id FROM (SELECT event_id, {HOLES_V} AS value, {HOLES_U} AS user_id FROM events) t
WHERE value IS NOT NULL AND NOT isnan(value) AND user_id IS NOT NULL""")
def drop_incomplete(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", F.expr(HOLES_V).alias("value"), F.expr(HOLES_U).alias("user_id"))
    return clean.drop_incomplete(raw)


NOISY_Q = """CASE (l_orderkey + l_linenumber) % 10 WHEN 0 THEN -l_quantity WHEN 1 THEN CAST('NaN' AS DOUBLE)
  WHEN 2 THEN CAST('Infinity' AS DOUBLE) WHEN 3 THEN CAST('-Infinity' AS DOUBLE) ELSE l_quantity END"""


@register("sanitize_features", f"""
SELECT l_orderkey, l_linenumber, {SANITIZE_SQL.format(x='q')} AS quantity, {SANITIZE_SQL.format(x='l_discount')} AS discount,
       {SANITIZE_SQL.format(x='l_tax')} AS tax
FROM (SELECT *, {NOISY_Q} AS q FROM lineitem) t""")
def sanitize_features(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(NOISY_Q).alias("quantity"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )
    return clean.sanitize_features(raw, ["quantity", "discount", "tax"])


@register("sanitize_vector", f"""
SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos,
       unnest(list_transform(embedding, lambda x: {SANITIZE_SQL.format(x='CAST(x AS DOUBLE)')})) AS value
FROM embeddings""")
def sanitize_vector(spark, sf_dir):
    em = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = clean.sanitize_vector(em, "embedding")
    exploded = out.select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    return exploded.select("vec_id", F.col("pos").cast("long").alias("pos"), "value")


@register("trim_column_names", """
SELECT l_orderkey, l_linenumber, l_returnflag AS "Label", l_quantity AS "Total Fwd Packets" FROM lineitem""")
def trim_column_names(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(" l_orderkey"), F.col("l_linenumber").alias("l_linenumber "),
        F.col("l_returnflag").alias(" Label"), F.col("l_quantity").alias("  Total Fwd Packets "))
    return clean.trim_column_names(raw)
