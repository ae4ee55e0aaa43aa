"""Votes, confusion, metrics and ranking over the rule predictors on ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowguard.catalog import R, register
from flowguard.checks.sql import EVENTS_RULES, RULE_METRICS, with_
from flowguard.operators import ensemble, metrics, ranking
from flowguard.plans.experiment import evaluate
from flowguard.sources.tables import RULES, event_labels, event_rule_predictions, table


def rule_evaluation(spark, sf_dir, only=None):
    labels = event_labels(spark, sf_dir)
    pred = event_rule_predictions(spark, sf_dir, labels)
    return evaluate(pred, "label_idx", [(m, p, pr) for m, (p, pr) in RULES.items()], labels, persist_confusion=True, only=only)


def _r(c: str):
    return F.round(F.col(c), R).alias(c)


ROUNDED = ("precision", "recall", "f1_weighted", "f1_macro")


@register("hard_vote", with_(EVENTS_RULES) + """
SELECT event_id, pred_rule_a, pred_rule_b, pred_rule_c, pred_ensemble_hard_vote FROM ev_all""")
def hard_vote(spark, sf_dir):
    pred = event_rule_predictions(spark, sf_dir)
    out = ensemble.hard_vote(pred, ["pred_rule_a", "pred_rule_b", "pred_rule_c"], "pred_ensemble_hard_vote")
    return out.select("event_id", "pred_rule_a", "pred_rule_b", "pred_rule_c", "pred_ensemble_hard_vote")


@register("soft_vote_probability", with_(EVENTS_RULES) + """
SELECT event_id, generate_subscripts(prob_ensemble_soft_vote, 1) - 1 AS pos, unnest(prob_ensemble_soft_vote) AS p
FROM ev_all""")
def soft_vote_probability(spark, sf_dir):
    pred = event_rule_predictions(spark, sf_dir)
    out = ensemble.soft_vote_probability(pred, ["prob_rule_a", "prob_rule_b", "prob_rule_c"], "prob")
    exploded = out.select("event_id", F.posexplode("prob").alias("pos", "p"))
    return exploded.select("event_id", F.col("pos").cast("long").alias("pos"), "p")


@register("vector_argmax", with_(EVENTS_RULES) + """
SELECT event_id,
  CAST(list_position(prob_rule_a, list_max(prob_rule_a)) - 1 AS DOUBLE) AS argmax_a,
  CAST(list_position(prob_rule_b, list_max(prob_rule_b)) - 1 AS DOUBLE) AS argmax_b,
  CAST(list_position(prob_rule_c, list_max(prob_rule_c)) - 1 AS DOUBLE) AS argmax_c
FROM ev_all""")
def vector_argmax(spark, sf_dir):
    pred = event_rule_predictions(spark, sf_dir)
    for src, out in (("prob_rule_a", "argmax_a"), ("prob_rule_b", "argmax_b"), ("prob_rule_c", "argmax_c")):
        pred = ensemble.vector_argmax(pred, src, out)
    return pred.select("event_id", "argmax_a", "argmax_b", "argmax_c")


@register("soft_vote", with_(EVENTS_RULES) + """
SELECT event_id, pred_ensemble_soft_vote FROM ev_all""")
def soft_vote(spark, sf_dir):
    pred = event_rule_predictions(spark, sf_dir)
    out = ensemble.soft_vote(pred, ["prob_rule_a", "prob_rule_b", "prob_rule_c"], "pred_ensemble_soft_vote")
    return out.select("event_id", "pred_ensemble_soft_vote")


@register("align_predictions", with_(EVENTS_RULES) + """
SELECT event_id, label_idx, pred_rule_a, pred_rule_b, pred_rule_c FROM ev_all""")
def align_predictions(spark, sf_dir):
    pred = event_rule_predictions(spark, sf_dir)
    parts = [pred.select("event_id", "label_idx", "pred_rule_a"), pred.select("event_id", "pred_rule_b"),
             pred.select("event_id", "pred_rule_c")]
    return ensemble.align_predictions(parts, "event_id")


@register("confusion_by_index", RULE_METRICS + """
SELECT label_idx, prediction, count FROM ev_conf WHERE model = 'rule_c'""")
def confusion_by_index(spark, sf_dir):
    pred = event_rule_predictions(spark, sf_dir)
    return metrics.confusion_by_index(pred, "label_idx", "pred_rule_c")


@register("confusion_by_label", RULE_METRICS + """
SELECT model, actual_label, predicted_label, count FROM ev_confn""")
def confusion_by_label(spark, sf_dir):
    ev = rule_evaluation(spark, sf_dir)
    return metrics.confusion_by_label(ev.confusion, ev.labels).select("model", "actual_label", "predicted_label", "count")


@register("distinct_classes", RULE_METRICS + """
SELECT DISTINCT model, class_idx FROM (
  SELECT model, label_idx AS class_idx FROM ev_conf UNION ALL SELECT model, prediction FROM ev_conf) t
WHERE class_idx IS NOT NULL""")
def distinct_classes(spark, sf_dir):
    return metrics.distinct_classes(rule_evaluation(spark, sf_dir).confusion).select("model", "class_idx")


@register("per_class_metrics", RULE_METRICS + """
SELECT model, label_idx, class_label, precision, recall, f1, support FROM ev_pcn""")
def per_class_metrics(spark, sf_dir):
    return rule_evaluation(spark, sf_dir).per_class.select(
        "model", "label_idx", "class_label", "precision", "recall", "f1", "support"
    )


@register("hard_vote_per_class", RULE_METRICS + """
SELECT class_label, precision, recall, f1, support FROM ev_pcn WHERE model = 'ensemble_hard_vote'""")
def hard_vote_per_class(spark, sf_dir):
    """Flagship: per-class precision/recall/F1 of the hard vote over three rule predictors."""
    per = rule_evaluation(spark, sf_dir, only=["ensemble_hard_vote"]).per_class
    return per.select("class_label", "precision", "recall", "f1", "support")


@register("per_class_all", RULE_METRICS + """
SELECT model, class_label, precision, recall, f1, support FROM ev_pcn""")
def per_class_all(spark, sf_dir):
    return ranking.per_class_all(rule_evaluation(spark, sf_dir).per_class).select(
        "model", "class_label", "precision", "recall", "f1", "support"
    )


@register("compute_metrics", RULE_METRICS + f"""
SELECT model, accuracy, round(precision, {R}) AS precision, round(recall, {R}) AS recall,
       round(f1_weighted, {R}) AS f1_weighted, round(f1_macro, {R}) AS f1_macro FROM ev_mm""")
def compute_metrics(spark, sf_dir):
    m = rule_evaluation(spark, sf_dir).metrics
    return m.select("model", "accuracy", *[_r(c) for c in ROUNDED])


@register("metrics_by_day", with_(EVENTS_RULES) + """
SELECT CAST(CAST(e.ts AS DATE) AS VARCHAR) AS day, l.model, count(*) AS rows,
       CAST(count(*) FILTER (WHERE l.prediction = l.label_idx) AS DOUBLE) / count(*) AS accuracy
FROM (SELECT event_id, 'rule_a' AS model, label_idx, pred_rule_a AS prediction FROM ev_pred
      UNION ALL SELECT event_id, 'rule_c', label_idx, pred_rule_c FROM ev_pred) l JOIN events e USING (event_id)
GROUP BY ALL""")
def metrics_by_day(spark, sf_dir):
    """Metrics per capture day and model from one aggregation."""
    days = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").cast("string").alias("day"))
    pred = event_rule_predictions(spark, sf_dir).join(days, "event_id")
    _, per, m = metrics.compute_metrics(pred, "label_idx", {"rule_a": "pred_rule_a", "rule_c": "pred_rule_c"}, by=["day"])
    rows = per.groupBy("day", "model").agg(F.sum("support").alias("rows"))
    return m.join(rows, ["day", "model"]).select("day", "model", "rows", "accuracy")


def _single_metric(key: str, col: str, rounded: bool):
    expr = f"round({col}, {R})" if rounded else col
    sql = RULE_METRICS + f"SELECT model, {expr} AS {col} FROM ev_mm"

    @register(key, sql)
    def q(spark, sf_dir):
        m = rule_evaluation(spark, sf_dir).metrics
        return m.select("model", _r(col) if rounded else F.col(col))

    q.__name__ = key
    return q


_single_metric("accuracy", "accuracy", False)
_single_metric("weighted_precision", "precision", True)
_single_metric("weighted_recall", "recall", True)
_single_metric("weighted_f1", "f1_weighted", True)
_single_metric("macro_f1", "f1_macro", True)


@register("rank_models", RULE_METRICS + f"""
SELECT model, kind, round(f1_macro, {R}) AS f1_macro,
       row_number() OVER (ORDER BY f1_macro DESC, position) AS rank FROM ev_cmp""")
def rank_models(spark, sf_dir):
    cmp = rule_evaluation(spark, sf_dir).comparison
    return ranking.rank_models(cmp).select("model", "kind", _r("f1_macro"), F.col("rank").cast("long").alias("rank"))


@register("best_single", RULE_METRICS + f"""
SELECT model AS best_single, round(f1_macro, {R}) AS f1_macro
FROM ev_cmp WHERE kind = 'single' ORDER BY f1_macro DESC, position LIMIT 1""")
def best_single(spark, sf_dir):
    return ranking.best_single(rule_evaluation(spark, sf_dir).comparison).select("best_single", _r("f1_macro"))


@register("best_overall", RULE_METRICS + f"""
SELECT model AS best_overall, round(f1_macro, {R}) AS f1_macro
FROM ev_cmp ORDER BY f1_macro DESC, position LIMIT 1""")
def best_overall(spark, sf_dir):
    return ranking.best_overall(rule_evaluation(spark, sf_dir).comparison).select("best_overall", _r("f1_macro"))


def _kind_rows(key: str, kind: str, fn):
    sql = RULE_METRICS + f"""
SELECT model, accuracy, round(precision, {R}) AS precision, round(recall, {R}) AS recall,
       round(f1_weighted, {R}) AS f1_weighted, round(f1_macro, {R}) AS f1_macro FROM ev_cmp WHERE kind = '{kind}'"""

    @register(key, sql)
    def q(spark, sf_dir):
        cmp = fn(rule_evaluation(spark, sf_dir).comparison)
        return cmp.select("model", "accuracy", *[_r(c) for c in ROUNDED])

    q.__name__ = key
    return q


_kind_rows("single_rows", "single", ranking.single_rows)
_kind_rows("ensemble_rows", "ensemble", ranking.ensemble_rows)


@register("run_ensembles", RULE_METRICS + f"""
SELECT 3 AS voters, model, accuracy, round(f1_macro, {R}) AS f1_macro FROM ev_cmp WHERE kind = 'ensemble'
UNION ALL SELECT 1, model, accuracy, round(f1_macro, {R}) FROM ev_cmp WHERE model = 'rule_a'""")
def run_ensembles(spark, sf_dir):
    """Votes need two models at least: three rule predictors give both ensembles, one gives none."""
    labels = event_labels(spark, sf_dir)
    pred = event_rule_predictions(spark, sf_dir, labels)
    singles = [(m, p, pr) for m, (p, pr) in RULES.items()]
    three = ranking.ensemble_rows(evaluate(pred, "label_idx", singles, labels).comparison)
    one = evaluate(pred, "label_idx", singles[:1], labels).comparison
    return three.withColumn("voters", F.lit(3)).unionByName(one.withColumn("voters", F.lit(1))).select("voters", "model", "accuracy", _r("f1_macro"))


@register("sample_rows", RULE_METRICS + """
SELECT model, actual_label, predicted_label, count FROM ev_confn
ORDER BY count DESC, model, actual_label, predicted_label NULLS FIRST LIMIT 30""")
def sample_rows(spark, sf_dir):
    """The 30 largest confusion cells (the reference shows the first 30 rows by count)."""
    ev = rule_evaluation(spark, sf_dir)
    named = metrics.confusion_by_label(ev.confusion, ev.labels)
    top = named.orderBy(F.desc("count"), "model", "actual_label", F.col("predicted_label").asc_nulls_first())
    return top.limit(30).select("model", "actual_label", "predicted_label", "count")


@register("join_predictions", with_(EVENTS_RULES) + """
SELECT event_id, label_idx, pred_rule_a, pred_rule_b, pred_rule_c FROM ev_all WHERE event_id % 7 <> 2 AND event_id % 5 <> 1""")
def join_predictions(spark, sf_dir):
    """Inner join of per-model frames on a row key: rows that one model lacks are left out."""
    pred = event_rule_predictions(spark, sf_dir)
    parts = [pred.select("event_id", "label_idx", "pred_rule_a"), pred.filter("event_id % 7 <> 2").select("event_id", "pred_rule_b"),
             pred.filter("event_id % 5 <> 1").select("event_id", "pred_rule_c")]
    return ensemble.align_predictions(parts, "event_id")


@register("support_filter", RULE_METRICS + """
SELECT model, class_label, support FROM ev_pcn WHERE support > 0""")
def support_filter(spark, sf_dir):
    """Support per class (rows of that class), from the one confusion aggregation."""
    per = rule_evaluation(spark, sf_dir).per_class
    return per.filter(F.col("support") > 0).select("model", "class_label", "support")
