"""Report tables, chart data and result-file sinks over the rule-predictor evaluation on events.

Sink queries write with Spark's writers into the shared scratch folder and return what was
read back, so the check covers the file contents (rounding, columns, partition folders).
"""

from __future__ import annotations

import functools

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowguard.catalog import R, register
from flowguard.checks.q_votes import rule_evaluation
from flowguard.checks.sql import RULE_METRICS
from flowguard.operators.metrics import confusion_by_label
from flowguard.operators.profile import label_distribution
from flowguard.operators.ranking import best_single as best_single_op
from flowguard.operators.ranking import comparison_table
from flowguard.plans import charts, report
from flowguard.session import scratch_path
from flowguard.sinks import writers
from flowguard.sources.tables import RULES, table

PRETTY_SQL = ("array_to_string(list_transform(string_split(replace({m}, '_', ' '), ' '), "
              "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')")
BEST_SINGLE_SQL = "(SELECT model FROM ev_cmp WHERE kind = 'single' ORDER BY f1_macro DESC, position LIMIT 1)"
PCT = "round(CAST(count(*) AS DOUBLE) * 100.0::DOUBLE / sum(count(*)) OVER (), 4)"


def _r(c, digits=R):
    return F.round(F.col(c), digits).alias(c)


def _events_label_dist(spark, sf_dir):
    return label_distribution(table(spark, sf_dir, "events").select(F.col("event_type").alias("label")), "label")


@register("pretty_model_name", RULE_METRICS + f"SELECT model, {PRETTY_SQL.format(m='model')} AS display_name FROM ev_cmp")
def pretty_model_name(spark, sf_dir):
    return charts.pretty_model_name(rule_evaluation(spark, sf_dir).comparison).select("model", "display_name")


@register("chart_label_counts", "SELECT event_type AS label, count(*) AS count FROM events GROUP BY event_type")
def chart_label_counts(spark, sf_dir):
    return charts.chart_label_counts(_events_label_dist(spark, sf_dir))


@register("chart_model_f1", RULE_METRICS + f"""
SELECT model, {PRETTY_SQL.format(m='model')} AS display_name,
       CASE WHEN contains(model, 'ensemble') THEN 'ensemble' ELSE 'single' END AS kind, round(f1_macro, {R}) AS f1_macro
FROM ev_cmp""")
def chart_model_f1(spark, sf_dir):
    out = charts.chart_model_f1(rule_evaluation(spark, sf_dir).comparison)
    return out.select("model", "display_name", "kind", _r("f1_macro"))


@register("chart_multi_metric", RULE_METRICS + f"""
SELECT model, metric, round(value, {R}) AS value FROM (
  UNPIVOT (SELECT model, accuracy, precision, recall, f1_macro FROM ev_cmp)
  ON accuracy, precision, recall, f1_macro INTO NAME metric VALUE value) t""")
def chart_multi_metric(spark, sf_dir):
    out = charts.chart_multi_metric(rule_evaluation(spark, sf_dir).comparison)
    return out.select("model", "metric", _r("value"))


@register("chart_single_vs_ensemble", RULE_METRICS + f"""
SELECT kind, model, round(f1_macro, {R}) AS f1_macro,
       row_number() OVER (PARTITION BY kind ORDER BY f1_macro DESC, position) AS rank_in_kind FROM ev_cmp""")
def chart_single_vs_ensemble(spark, sf_dir):
    out = charts.chart_single_vs_ensemble(rule_evaluation(spark, sf_dir).comparison)
    return out.select("kind", "model", _r("f1_macro"), F.col("rank_in_kind").cast("long").alias("rank_in_kind"))


MODELS = (*RULES, "ensemble_hard_vote", "ensemble_soft_vote")


@register("chart_class_f1_heatmap", RULE_METRICS + f"""
SELECT class_label, {", ".join(f"max(f1) FILTER (WHERE model = '{m}') AS {m}" for m in MODELS)}
FROM ev_pcn GROUP BY class_label""")
def chart_class_f1_heatmap(spark, sf_dir):
    return charts.chart_class_f1_heatmap(rule_evaluation(spark, sf_dir).per_class)


@register("chart_accuracy_recall", RULE_METRICS + f"""
SELECT model, kind, round(recall, {R}) AS recall, accuracy FROM ev_cmp""")
def chart_accuracy_recall(spark, sf_dir):
    out = charts.chart_accuracy_recall(rule_evaluation(spark, sf_dir).comparison)
    return out.select("model", "kind", _r("recall"), "accuracy")


@register("chart_accuracy_f1", RULE_METRICS + f"""
SELECT model, kind, accuracy, round(f1_macro, {R}) AS f1_macro FROM ev_cmp""")
def chart_accuracy_f1(spark, sf_dir):
    out = charts.chart_accuracy_f1(rule_evaluation(spark, sf_dir).comparison)
    return out.select("model", "kind", "accuracy", _r("f1_macro"))


@register("chart_training_time", RULE_METRICS + """
SELECT model, train_time_sec, row_number() OVER (ORDER BY train_time_sec, position) AS line FROM (
  SELECT model, position, CASE model WHEN 'rule_a' THEN 2.5::DOUBLE WHEN 'rule_c' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END
    AS train_time_sec FROM ev_cmp) t""")
def chart_training_time(spark, sf_dir):
    """Bars by training time; what took no training (here the votes and rule_b) has 0 seconds and comes first."""
    comparison = comparison_table(rule_evaluation(spark, sf_dir).metrics, {"rule_a": 2.5, "rule_c": 0.5})
    order = Window.orderBy("train_time_sec", "position")  # one row per model
    return charts.chart_training_time(comparison).select("model", "train_time_sec", F.row_number().over(order).cast("long").alias("line"))


@register("chart_ensemble_gain", RULE_METRICS + f""",
best AS (SELECT * FROM ev_cmp WHERE kind = 'single' ORDER BY f1_macro DESC, position LIMIT 1),
bl AS (UNPIVOT (SELECT model, accuracy, precision, recall, f1_macro FROM best)
       ON accuracy, precision, recall, f1_macro INTO NAME metric VALUE best_single_value),
el AS (UNPIVOT (SELECT model, accuracy, precision, recall, f1_macro FROM ev_cmp WHERE kind = 'ensemble')
       ON accuracy, precision, recall, f1_macro INTO NAME metric VALUE ensemble_value)
SELECT el.model AS ensemble, bl.model AS best_single, el.metric, round(bl.best_single_value, {R}) AS best_single_value,
       round(el.ensemble_value, {R}) AS ensemble_value, round(el.ensemble_value - bl.best_single_value, {R}) AS gain
FROM el JOIN bl ON el.metric = bl.metric""")
def chart_ensemble_gain(spark, sf_dir):
    out = charts.chart_ensemble_gain(rule_evaluation(spark, sf_dir).comparison)
    return out.select("ensemble", "best_single", "metric", _r("best_single_value"), _r("ensemble_value"), _r("gain"))


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@register("chart_confusion_dense", RULE_METRICS + f""",
cells AS (SELECT actual_label, predicted_label, count FROM ev_confn WHERE model = 'rule_b' AND predicted_label IS NOT NULL),
classes AS (SELECT actual_label AS k FROM cells UNION SELECT predicted_label FROM cells)
SELECT k AS actual_label, {", ".join(f"CAST(coalesce(sum(count) FILTER (WHERE predicted_label = '{c}'), 0) AS BIGINT) AS {c}"
                                     for c in ("__unknown", *EVENT_TYPES))}
FROM classes LEFT JOIN cells ON actual_label = k GROUP BY k""")
def chart_confusion_dense(spark, sf_dir):
    """Square matrix of rule_b, which predicts a class beyond the labels: its row is all zeros."""
    ev = rule_evaluation(spark, sf_dir)
    return charts.chart_confusion_dense(ev.confusion, ev.labels, "rule_b")


def _lines(spark, schema, path):
    """The rows of a one-file table with their line numbers, so that a check covers the order."""
    return spark.read.schema(schema).option("header", True).csv(path).withColumn("line", F.monotonically_increasing_id() + 1)


# ---- sinks: write, read back ------------------------------------------------------------------

@register("write_label_distribution", f"""
SELECT *, row_number() OVER (ORDER BY count DESC, label) AS line FROM (
  SELECT event_type AS label, count(*) AS count, {PCT} AS percent FROM events GROUP BY event_type) t""")
def write_label_distribution(spark, sf_dir):
    path = writers.write_label_distribution(_events_label_dist(spark, sf_dir), scratch_path(spark, "label-dist"))
    return _lines(spark, writers.LABEL_DIST_SCHEMA, path)


CMP6 = """SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1_weighted, 6) AS f1_weighted, round(f1_macro, 6) AS f1_macro, 0.0::DOUBLE AS train_time_sec"""


@register("write_comparison", RULE_METRICS + CMP6 + ", row_number() OVER (ORDER BY f1_macro DESC, position) AS line FROM ev_cmp")
def write_comparison(spark, sf_dir):
    path = writers.write_comparison(rule_evaluation(spark, sf_dir).comparison, scratch_path(spark, "comparison"))
    return _lines(spark, writers.COMPARISON_SCHEMA, path)


@register("write_single_ensemble", RULE_METRICS + CMP6 + """, kind,
       row_number() OVER (PARTITION BY kind ORDER BY f1_macro DESC, position) AS line FROM ev_cmp""")
def write_single_ensemble(spark, sf_dir):
    paths = writers.write_single_ensemble(rule_evaluation(spark, sf_dir).comparison, scratch_path(spark, "single-ens") + "/single_vs_ensemble")
    parts = [_lines(spark, writers.COMPARISON_SCHEMA, p).withColumn("kind", F.lit(k.rpartition("/")[2])) for k, p in sorted(paths.items())]
    return parts[0].unionByName(parts[1])


@register("write_per_class", RULE_METRICS + """
SELECT model, class_label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support,
       row_number() OVER (ORDER BY position, label_idx) AS line FROM ev_pcn""")
def write_per_class(spark, sf_dir):
    path = writers.write_per_class(rule_evaluation(spark, sf_dir).per_class, scratch_path(spark, "per-class"))
    return _lines(spark, writers.PER_CLASS_SCHEMA, path)


@register("write_confusion", RULE_METRICS + f"""
SELECT actual_label, predicted_label, count,
       row_number() OVER (ORDER BY count DESC, actual_label, predicted_label NULLS FIRST) AS line
FROM ev_confn WHERE model = {BEST_SINGLE_SQL}""")
def write_confusion(spark, sf_dir):
    ev = rule_evaluation(spark, sf_dir)
    best = best_single_op(ev.comparison).first()["best_single"]
    named = confusion_by_label(ev.confusion.filter(F.col("model") == best), ev.labels)
    path = writers.write_confusion(named, scratch_path(spark, "confusion"))
    return _lines(spark, writers.CONFUSION_SCHEMA, path)


@register("write_experiment_json", RULE_METRICS + f"""
SELECT 'events' AS dataset, 'multiclass' AS classification_mode, 'none' AS split_mode,
  {BEST_SINGLE_SQL} AS best_single,
  (SELECT model FROM ev_cmp ORDER BY f1_macro DESC, position LIMIT 1) AS best_overall,
  '{", ".join(RULES)}' AS models, 'gbt: binary only' AS skipped,
  (SELECT string_agg(model, ', ' ORDER BY f1_macro DESC, position) FROM ev_cmp) AS comparison,
  (SELECT string_agg(model || ' ' || class_label || ' ' || CAST(support AS VARCHAR), ', ' ORDER BY position, label_idx) FROM ev_pcn) AS per_class,
  (SELECT round(sum(f1), 6) FROM ev_pcn) AS sum_f1""")
def write_experiment_json(spark, sf_dir):
    ev = rule_evaluation(spark, sf_dir)
    rec = writers.experiment_record(ev.comparison, ev.per_class, "events", "multiclass", "none", models=list(RULES), skipped={"gbt": "binary only"})
    path = writers.write_experiment_json(rec, scratch_path(spark, "experiment-json"))
    back = spark.read.schema(writers.EXPERIMENT_JSON_SCHEMA).json(path)
    rows = F.transform("per_class", lambda x: F.concat_ws(" ", x["model"], x["class_label"], x["support"].cast("string")))
    return back.select(
        "dataset", "classification_mode", "split_mode", "best_single", "best_overall",
        F.array_join("models", ", ").alias("models"),
        F.array_join(F.transform("skipped", lambda x: F.concat(x["model"], F.lit(": "), x["reason"])), ", ").alias("skipped"),
        F.array_join(F.transform("comparison", lambda x: x["model"]), ", ").alias("comparison"),
        F.array_join(rows, ", ").alias("per_class"),
        F.round(F.aggregate("per_class", F.lit(0.0), lambda a, x: a + x["f1"]), 6).alias("sum_f1"),
    )


def _ranked_sql(name: str, where: str) -> str:
    return f"""
UNION ALL SELECT '{name}', row_number() OVER (ORDER BY f1_macro DESC, position), model, CAST(CAST(f1_macro AS DECIMAL(9, 6)) AS VARCHAR)
FROM ev_cmp WHERE {where}"""


@register("report_tables", RULE_METRICS + f"""
SELECT 'table1_configuration' AS "table", 0 AS line, key, value FROM (VALUES
  ('dataset', 'events'), ('data_profile', 'test tables'), ('classification', 'multiclass'), ('split', 'none'),
  ('sample_fraction', '100%'), ('class_weights', 'False'), ('fast_mode', 'False')) t(key, value)
UNION ALL SELECT 'table1_configuration', 0, 'total_records', CAST(count(*) AS VARCHAR) FROM events
UNION ALL SELECT 'table2_label_distribution', row_number() OVER (ORDER BY count(*) DESC, event_type), event_type, CAST(count(*) AS VARCHAR)
FROM events GROUP BY event_type
{_ranked_sql("table3_single_models", "kind = 'single'")}
{_ranked_sql("table4_ensembles", "kind = 'ensemble'")}
{_ranked_sql("table5_ranking", "true")}
UNION ALL SELECT 'table6_per_class_best', 0, class_label, CAST(CAST(f1 AS DECIMAL(9, 6)) AS VARCHAR) FROM ev_pcn
WHERE model = (SELECT model FROM ev_cmp ORDER BY f1_macro DESC, position LIMIT 1)
UNION ALL SELECT 'key_findings', 0, 'best_single', {PRETTY_SQL.format(m=BEST_SINGLE_SQL)}
UNION ALL SELECT 'key_findings', 0, 'best_overall',
  {PRETTY_SQL.format(m='(SELECT model FROM ev_cmp ORDER BY f1_macro DESC, position LIMIT 1)')}""")
def report_tables(spark, sf_dir):
    """All seven tables as rows of table, line (0 where the order is free), key and value."""
    ev = rule_evaluation(spark, sf_dir)
    dist = _events_label_dist(spark, sf_dir)
    cfg = report.report_config(dist, "events", "test tables", "multiclass", "none", 1.0, False, False)
    tables = report.report_tables(dist, ev.comparison, ev.per_class, cfg)
    f1 = lambda c: F.col(c).cast("decimal(9,6)").cast("string")
    values = {"table2_label_distribution": ("label", F.col("count").cast("string"), [F.desc("count"), "label"]),
              "table6_per_class_best": ("class_label", f1("f1"), None)}
    values |= dict.fromkeys(("table3_single_models", "table4_ensembles", "table5_ranking"), ("model", f1("f1_macro"), [F.desc("f1_macro"), "position"]))
    parts = []
    for name, df in tables.items():
        key, value, order = values.get(name, ("key", F.col("value"), None))
        line = F.row_number().over(Window.orderBy(*order)) if order else F.lit(0)  # at most a row per class or model
        parts.append(df.select(F.lit(name).alias("table"), line.cast("long").alias("line"), F.col(key).alias("key"), value.alias("value")))
    return functools.reduce(lambda a, b: a.unionByName(b), parts)
