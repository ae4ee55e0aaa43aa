"""DuckDB SQL fragments shared by the oracles (CTE bodies, comma-separated)."""

from __future__ import annotations

# Events with a frequency label index and the three rule predictors, their probability
# arrays, the hard vote (most votes, smallest on ties) and the soft vote (padded mean, argmax).
EVENTS_RULES = """
ev_lbl AS (
  SELECT event_type AS label,
         CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS label_idx
  FROM events GROUP BY event_type),
ev_names AS (
  SELECT label AS name, label_idx AS idx FROM ev_lbl
  UNION ALL SELECT '__unknown', CAST((SELECT count(*) FROM ev_lbl) AS DOUBLE)),
ev_pred AS (
  SELECT e.event_id, l.label, l.label_idx,
    CAST(CASE WHEN e.value < 50 THEN 0 WHEN e.value < 150 THEN 1 ELSE 2 END AS DOUBLE) AS pred_rule_a,
    CAST(e.event_id % 6 AS DOUBLE) AS pred_rule_b,
    CAST(CASE WHEN e.event_id % 50 = 7 THEN NULL ELSE e.user_id % 5 END AS DOUBLE) AS pred_rule_c
  FROM events e LEFT JOIN ev_lbl l ON e.event_type = l.label),
ev_prob AS (
  SELECT *,
    list_transform(range(3), lambda i: CASE WHEN i = pred_rule_a THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END) AS prob_rule_a,
    list_transform(range(6), lambda i: CASE WHEN i = pred_rule_b THEN 0.375::DOUBLE ELSE 0.125::DOUBLE END) AS prob_rule_b,
    CASE WHEN pred_rule_c IS NULL THEN NULL
         ELSE list_transform(range(5), lambda i: CASE WHEN i = pred_rule_c THEN 0.5::DOUBLE ELSE 0.125::DOUBLE END)
    END AS prob_rule_c
  FROM ev_pred),
ev_votes AS (
  SELECT event_id, v, count(*) AS c FROM (
    SELECT event_id, unnest([pred_rule_a, pred_rule_b, pred_rule_c]) AS v FROM ev_pred) t
  WHERE v IS NOT NULL GROUP BY event_id, v),
ev_hard AS (
  SELECT event_id, v AS pred_ensemble_hard_vote FROM (
    SELECT event_id, v, row_number() OVER (PARTITION BY event_id ORDER BY c DESC, v) AS rn FROM ev_votes) t
  WHERE rn = 1),
ev_soft0 AS (
  SELECT event_id, prob_rule_a, prob_rule_b, prob_rule_c,
    (CASE WHEN prob_rule_a IS NULL THEN 0 ELSE 1 END + CASE WHEN prob_rule_b IS NULL THEN 0 ELSE 1 END
     + CASE WHEN prob_rule_c IS NULL THEN 0 ELSE 1 END) AS n,
    greatest(coalesce(len(prob_rule_a), 0), coalesce(len(prob_rule_b), 0), coalesce(len(prob_rule_c), 0)) AS maxlen
  FROM ev_prob),
ev_soft1 AS (
  SELECT event_id, CASE WHEN n = 0 THEN NULL ELSE list_transform(range(maxlen), lambda i:
      (((0.0::DOUBLE + coalesce(prob_rule_a[i + 1], 0.0::DOUBLE)) + coalesce(prob_rule_b[i + 1], 0.0::DOUBLE))
        + coalesce(prob_rule_c[i + 1], 0.0::DOUBLE)) / n) END AS prob_ensemble_soft_vote
  FROM ev_soft0),
ev_soft AS (
  SELECT event_id, prob_ensemble_soft_vote,
    CAST(list_position(prob_ensemble_soft_vote, list_max(prob_ensemble_soft_vote)) - 1 AS DOUBLE) AS pred_ensemble_soft_vote
  FROM ev_soft1),
ev_all AS (
  SELECT p.*, h.pred_ensemble_hard_vote, s.prob_ensemble_soft_vote, s.pred_ensemble_soft_vote
  FROM ev_prob p LEFT JOIN ev_hard h ON p.event_id = h.event_id LEFT JOIN ev_soft s ON p.event_id = s.event_id),
ev_long AS (
  SELECT 'rule_a' AS model, 0 AS position, label_idx, pred_rule_a AS prediction FROM ev_all
  UNION ALL SELECT 'rule_b', 1, label_idx, pred_rule_b FROM ev_all
  UNION ALL SELECT 'rule_c', 2, label_idx, pred_rule_c FROM ev_all
  UNION ALL SELECT 'ensemble_hard_vote', 3, label_idx, pred_ensemble_hard_vote FROM ev_all
  UNION ALL SELECT 'ensemble_soft_vote', 4, label_idx, pred_ensemble_soft_vote FROM ev_all)
"""


def metrics(src: str, names: str | None = None) -> str:
    """Confusion, per-class and per-model metric CTEs over ``{src}_long(model, position, label_idx, prediction)``.

    ``names`` is a CTE (name, idx) used for class names (``__unknown`` at index n).
    """
    name_sql = ""
    if names:
        name_sql = f""",
{src}_pcn AS (
  SELECT pc.*, coalesce(nm.name, CAST(CAST(pc.label_idx AS INTEGER) AS VARCHAR)) AS class_label
  FROM {src}_pc pc LEFT JOIN {names} nm ON pc.label_idx = nm.idx),
{src}_confn AS (
  SELECT c.model, c.position,
    coalesce(a.name, CAST(CAST(c.label_idx AS INTEGER) AS VARCHAR)) AS actual_label,
    CASE WHEN c.prediction IS NULL THEN NULL ELSE coalesce(p.name, CAST(CAST(c.prediction AS INTEGER) AS VARCHAR)) END AS predicted_label,
    c.count
  FROM {src}_conf c LEFT JOIN {names} a ON c.label_idx = a.idx LEFT JOIN {names} p ON c.prediction = p.idx)"""
    return f"""
{src}_conf AS (
  SELECT model, position, label_idx, prediction, count(*) AS count FROM {src}_long
  WHERE label_idx IS NOT NULL GROUP BY model, position, label_idx, prediction),
{src}_roles AS (
  SELECT model, position, label_idx AS k, count AS support,
         CASE WHEN prediction = label_idx THEN count ELSE 0 END AS tp, 0 AS predicted FROM {src}_conf
  UNION ALL
  SELECT model, position, prediction AS k, 0 AS support, 0 AS tp, count AS predicted FROM {src}_conf
  WHERE prediction IS NOT NULL),
{src}_pc0 AS (
  SELECT model, position, k AS label_idx, CAST(sum(support) AS BIGINT) AS support,
         CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(predicted) AS BIGINT) AS predicted
  FROM {src}_roles GROUP BY model, position, k),
{src}_pc1 AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0::DOUBLE END AS precision,
            CASE WHEN support > 0 THEN tp / support ELSE 0.0::DOUBLE END AS recall FROM {src}_pc0),
{src}_pc AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE
                 ELSE 2.0::DOUBLE * precision * recall / (precision + recall) END AS f1 FROM {src}_pc1),
{src}_mm AS (
  SELECT model, position,
    coalesce(sum(tp) / sum(support), 0.0::DOUBLE) AS accuracy,
    coalesce(sum(precision * support) / sum(support), 0.0::DOUBLE) AS precision,
    coalesce(sum(recall * support) / sum(support), 0.0::DOUBLE) AS recall,
    coalesce(sum(f1 * support) / sum(support), 0.0::DOUBLE) AS f1_weighted,
    coalesce(avg(f1), 0.0::DOUBLE) AS f1_macro
  FROM {src}_pc GROUP BY model, position),
{src}_cmp AS (
  SELECT model, position,
    CASE WHEN model IN ('ensemble_hard_vote', 'ensemble_soft_vote') THEN 'ensemble' ELSE 'single' END AS kind,
    accuracy, precision, recall, f1_weighted, f1_macro FROM {src}_mm){name_sql}
"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes if c.strip()) + "\n"


RULE_METRICS = with_(EVENTS_RULES, metrics("ev", "ev_names"))
