"""Indexing, feature pipeline and MLlib model queries.

Naive Bayes has a closed form (class priors and per-class feature log-frequencies), so its
fitted parameters get a SQL oracle. LR, RF and GBT results depend on MLlib's optimisers and
tree induction: their queries return one row per test flow with its label index and invariant
flags, checked against the same split in SQL.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowguard.catalog import ORACLES, R, register
from flowguard.checks.sql import EVENTS_RULES, with_
from flowguard.checks.sql import metrics as metrics_sql
from flowguard.config import ExperimentConfig
from flowguard.operators import certify, features, models
from flowguard.operators.split import split_by_hash, split_by_source
from flowguard.operators.weights import add_class_weights
from flowguard.plans.experiment import run_both_splits as run_both_splits_plan
from flowguard.plans.experiment import run_experiment as run_experiment_plan
from flowguard.session import drop_table, materialize
from flowguard.sources.tables import (
    DOCUMENT_FEATURES,
    LINEITEM_FEATURES,
    document_flows,
    embedding_features,
    embedding_flows,
    event_flows,
    event_labels,
    event_rule_predictions,
    lineitem_flows,
    table,
)

TRAIN_DAYS = [f"day-{y}.csv" for y in range(1995, 2000)]
TEST_DAYS = [f"day-{y}.csv" for y in range(2000, 2002)]
SAN = "CASE WHEN isnan({x}) OR {x} <= 0 OR {x} = CAST('Infinity' AS DOUBLE) THEN 0.0::DOUBLE ELSE {x} END"


@register("index_labels", with_(EVENTS_RULES) + """
SELECT e.event_id, e.event_type AS label, l.label_idx FROM events e JOIN ev_lbl l ON e.event_type = l.label""")
def index_labels(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("label"))
    out, _ = features.index_labels(ev, "label")
    return out


def _rank_sql(expr: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {expr} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {expr}) - 1 AS DOUBLE) AS idx
  FROM lineitem GROUP BY {expr})"""


SERVICE = "'svc' || CAST(l_partkey % 41 AS STRING)"


@register("index_categories", "WITH " + ",\n".join([
    _rank_sql("l_returnflag", "rf"), _rank_sql("l_linestatus", "ls"), _rank_sql(SERVICE, "sv")]) + f"""
SELECT l.l_orderkey, l.l_linenumber, rf.idx AS l_returnflag_idx, ls.idx AS l_linestatus_idx, sv.idx AS service_idx
FROM lineitem l JOIN rf ON l.l_returnflag = rf.v JOIN ls ON l.l_linestatus = ls.v JOIN sv ON {SERVICE} = sv.v""")
def index_categories(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", F.expr(SERVICE).alias("service"))
    out, _ = features.index_categories(li, ["l_returnflag", "l_linestatus", "service"])
    return out.select("l_orderkey", "l_linenumber", "l_returnflag_idx", "l_linestatus_idx", "service_idx")


FLOW_KEY = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"


@register("index_categories_wide", "WITH " + ",\n".join([_rank_sql(FLOW_KEY, "fk"), _rank_sql("CAST(l_partkey AS STRING)", "pk")]) + f"""
SELECT l.l_orderkey, l.l_linenumber, fk.idx AS flow_key_idx, pk.idx AS l_partkey_idx
FROM lineitem l JOIN fk ON {FLOW_KEY} = fk.v JOIN pk ON CAST(l_partkey AS STRING) = pk.v""")
def index_categories_wide(spark, sf_dir):
    """Columns with as many values as rows and with thousands: ranks by range partition, joined on the value."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr(FLOW_KEY).alias("flow_key"))
    out, _ = features.index_categories(li, ["flow_key", "l_partkey"])
    return out.select("l_orderkey", "l_linenumber", "flow_key_idx", "l_partkey_idx")


@register("index_to_label", with_(EVENTS_RULES) + """
SELECT p.event_id, coalesce(n.name, CAST(CAST(p.pred_rule_b AS INTEGER) AS VARCHAR)) AS predicted_label
FROM ev_pred p LEFT JOIN ev_names n ON p.pred_rule_b = n.idx""")
def index_to_label(spark, sf_dir):
    labels = event_labels(spark, sf_dir)
    pred = event_rule_predictions(spark, sf_dir, labels)
    return features.index_to_label(pred, "pred_rule_b", labels, "predicted_label").select("event_id", "predicted_label")


def _lineitem_split(spark, sf_dir):
    flows = lineitem_flows(spark, sf_dir)
    return split_by_source(flows, TRAIN_DAYS, TEST_DAYS)


LI_TRAIN = f"""
tr AS (
  SELECT l_returnflag AS label, {SAN.format(x='l_quantity')} AS f0, {SAN.format(x='l_extendedprice')} AS f1,
         {SAN.format(x='l_discount')} AS f2, {SAN.format(x='l_tax')} AS f3
  FROM lineitem WHERE year(l_shipdate) <= 1999),
lbl AS (
  SELECT label, CAST(row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS DOUBLE) AS label_idx FROM tr GROUP BY label)"""


@register("feature_pipeline", f"""WITH {LI_TRAIN}
SELECT t.l_orderkey, t.l_linenumber, coalesce(lbl.label_idx, CAST((SELECT count(*) FROM lbl) AS DOUBLE)) AS label_idx,
  {SAN.format(x='t.l_quantity')} AS f_0, {SAN.format(x='t.l_extendedprice')} AS f_1,
  {SAN.format(x='t.l_discount')} AS f_2, {SAN.format(x='t.l_tax')} AS f_3
FROM lineitem t LEFT JOIN lbl ON t.l_returnflag = lbl.label WHERE year(t.l_shipdate) >= 2000""")
def feature_pipeline(spark, sf_dir):
    """Fit indexers + sanitising + assembler on the training days; transform the test days."""
    train, test = _lineitem_split(spark, sf_dir)
    pipe = features.feature_pipeline(LINEITEM_FEATURES)
    prep = pipe.fit(train)
    arr = vector_to_array(F.col("features"))
    return prep.transform(test).select(
        "l_orderkey", "l_linenumber", "label_idx", *[arr[i].alias(f"f_{i}") for i in range(len(LINEITEM_FEATURES))]
    )


@register("preprocess", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN upper(trim(l_returnflag)) = 'N' THEN 'normal' ELSE 'attack' END AS label,
  CASE WHEN (l_returnflag = 'N') = (n > total - n) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label_idx,
  {", ".join(f"{SAN.format(x=c)} AS f_{i}" for i, c in enumerate(LINEITEM_FEATURES))}
FROM (SELECT *, count(*) OVER () AS total, count(*) FILTER (WHERE l_returnflag = 'N') OVER () AS n
      FROM lineitem WHERE l_orderkey % 11 <> 5) t""")
def preprocess(spark, sf_dir):
    """Rows without a null (every 11th order gets one), labels, label index by frequency and the sanitised features."""
    from flowguard.plans.experiment import prepare

    cfg = ExperimentConfig(mode="binary", normal_label="N")
    flows = lineitem_flows(spark, sf_dir).withColumn("l_tax", F.expr("CASE WHEN l_orderkey % 11 <> 5 THEN l_tax END"))
    prepared = prepare(flows, cfg)
    out = features.feature_pipeline(LINEITEM_FEATURES).fit(prepared).transform(prepared)
    arr = vector_to_array(F.col("features"))
    return out.select("l_orderkey", "l_linenumber", "label", "label_idx", *[arr[i].alias(f"f_{i}") for i in range(len(LINEITEM_FEATURES))])


@register("naive_bayes", f"""WITH {LI_TRAIN},
tot AS (SELECT count(*) AS n_all, (SELECT count(*) FROM lbl) AS k FROM tr),
cls AS (
  SELECT lbl.label_idx, count(*) AS n, sum(f0) AS s0, sum(f1) AS s1, sum(f2) AS s2, sum(f3) AS s3
  FROM tr JOIN lbl ON tr.label = lbl.label GROUP BY lbl.label_idx),
feat AS (
  SELECT label_idx, n, unnest([0, 1, 2, 3]) AS feature, unnest([s0, s1, s2, s3]) AS s, s0 + s1 + s2 + s3 AS s_all FROM cls)
SELECT label_idx, feature, round(ln(n + 1.0) - ln(n_all + k * 1.0), 6) AS pi,
       round(ln(s + 1.0) - ln(s_all + 4 * 1.0), 6) AS theta
FROM feat, tot""")
def naive_bayes(spark, sf_dir):
    """Multinomial NB (smoothing 1) on the training days: fitted log priors and log conditionals."""
    train, _ = _lineitem_split(spark, sf_dir)
    prep = features.feature_pipeline(LINEITEM_FEATURES).fit(train)
    train_p = prep.transform(train).select("label_idx", "features")
    nb = models.build_classifier("naive_bayes", ExperimentConfig(class_weights=False)).fit(train_p)
    pi, theta = nb.pi.toArray(), nb.theta.toArray()  # classes x features: model parameters
    rows = [(float(c), j, float(pi[c]), float(theta[c][j])) for c in range(len(pi)) for j in range(theta.shape[1])]
    params = spark.createDataFrame(rows, "label_idx double, feature int, pi double, theta double")
    return params.select("label_idx", "feature", F.round("pi", 6).alias("pi"), F.round("theta", 6).alias("theta"))


#: A slope of the regularised loss below this counts as 0 (the fit stops at a relative change of 1e-6).
FLAT = 1e-3


def _certified(scored, train, fitted, name: str, cfg):
    """``scored`` with ``as_computed``: the model's output equals the native evaluation (and its fit is the optimum, for logistic regression)."""
    if name == "random_forest":
        return certify.forest_prediction(scored, fitted, "own").withColumn("as_computed", F.col("own") == F.col(models.pred_col(name)))
    if name == "gradient_boosted_trees":
        return certify.boosted_prediction(scored, fitted, "own").withColumn("as_computed", F.col("own") == F.col(models.pred_col(name)))
    slope = certify.logistic_gradient(train, fitted, cfg.lr_reg, "weight")
    out = certify.with_logistic_probabilities(scored, fitted, "own")
    far = F.zip_with("own", vector_to_array(F.col(models.prob_col(name))), lambda a, b: F.abs(a - b))
    return out.withColumn("as_computed", (F.array_max(far) < 1e-9) & F.lit(bool(abs(slope).max() < FLAT)))


def _invariants(scored, name: str, n_labels: int, key: str):
    prob = vector_to_array(F.col(models.prob_col(name)))
    total = F.aggregate(prob, F.lit(0.0), lambda a, x: a + x)
    return scored.select(
        key, "label_idx",
        (F.abs(total - 1.0) < 1e-6).alias("prob_sums_to_one"),
        F.col(models.pred_col(name)).between(0, n_labels).alias("known_class"), "as_computed",
    )


def _single_model_query(key: str, name: str, flows_fn, feats, id_col: str, rows_sql: str):
    sql = f"""WITH flows AS ({rows_sql}),
parts AS (SELECT *, ('0x' || substr(md5(CAST({id_col} AS VARCHAR) || ':42'), 1, 8))::BIGINT % 10000 < 8000 AS train FROM flows),
lbl AS (SELECT label, CAST(row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS DOUBLE) AS label_idx
        FROM parts WHERE train GROUP BY label)
SELECT {id_col}, coalesce(label_idx, CAST((SELECT count(*) FROM lbl) AS DOUBLE)) AS label_idx,
       true AS prob_sums_to_one, true AS known_class, true AS as_computed
FROM parts LEFT JOIN lbl USING (label) WHERE NOT train"""

    @register(key, sql)
    def q(spark, sf_dir):
        flows = flows_fn(spark, sf_dir)
        columns = feats(spark, sf_dir) if callable(feats) else feats
        train, test = split_by_hash(flows, [id_col], 0.8, 42)
        prep = features.feature_pipeline(columns).fit(train)
        labels = features.fitted_label_names(prep)
        train_p = materialize(add_class_weights(prep.transform(train).select("label_idx", "features"), "label_idx"))
        cfg = ExperimentConfig(class_weights=True)
        fitted = models.build_classifier(name, cfg).fit(train_p)
        scored = _certified(fitted.transform(prep.transform(test).select(id_col, "label_idx", "features")), train_p, fitted, name, cfg)
        drop_table(train_p)
        return _invariants(scored, name, len(labels), id_col)

    q.__name__ = key
    q.__doc__ = f"{name} on a hash split of {flows_fn.__name__}: one row per test flow with invariant flags, its output evaluated natively."
    return q


EMB_SQL = "SELECT vec_id, CAST(label AS VARCHAR) AS label FROM embeddings"
DOC_SQL = "SELECT doc_id, CAST(quality AS VARCHAR) AS label FROM documents JOIN labels USING (doc_id)"
_single_model_query("logistic_regression", "logistic_regression", embedding_flows, embedding_features, "vec_id", EMB_SQL)
_single_model_query("random_forest", "random_forest", embedding_flows, embedding_features, "vec_id", EMB_SQL)
_single_model_query("gradient_boosted_trees", "gradient_boosted_trees", document_flows, DOCUMENT_FEATURES, "doc_id", DOC_SQL)


@register("train_models", f"""WITH {LI_TRAIN}
SELECT position, model, 4 AS num_features, (SELECT count(*) FROM tr) AS rows, (SELECT count(*) FROM tr) AS known
FROM (VALUES (0, 'naive_bayes'), (1, 'logistic_regression'), (2, 'random_forest')) t(position, model)""")
def train_models(spark, sf_dir):
    """NB, LR and RF fitted in training order; each scores all training rows with a class of the label list."""
    train, _ = _lineitem_split(spark, sf_dir)
    prep = features.feature_pipeline(LINEITEM_FEATURES).fit(train)
    k = len(features.fitted_label_names(prep))
    train_p = materialize(add_class_weights(prep.transform(train).select("label_idx", "features"), "label_idx"))
    cfg = ExperimentConfig(models=("nb", "lr", "rf"))
    fitted = models.train_models(train_p, models.select_models(cfg, n_classes=k)[0], cfg)
    scored = models.score_models(train_p, fitted)
    rows = F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("model"), F.lit(int(m.numFeatures)).alias("num_features"),
                 F.col(models.pred_col(n)).alias("p")) for i, (n, m, _) in enumerate(fitted)]))
    return scored.select(rows).groupBy("position", "model", "num_features").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("p").between(0, k - 1)).alias("known"))


@register("score_models")
def score_models(spark, sf_dir):
    """NB and RF fitted on the training days score the test days in one chained pass."""
    train, test = _lineitem_split(spark, sf_dir)
    prep = features.feature_pipeline(LINEITEM_FEATURES).fit(train)
    k = len(features.fitted_label_names(prep))
    train_p = materialize(add_class_weights(prep.transform(train).select("label_idx", "features"), "label_idx"))
    cfg = ExperimentConfig(fast=True)
    fitted = models.train_models(train_p, models.select_models(cfg)[0], cfg)
    drop_table(train_p)
    scored = models.score_models(prep.transform(test).select("l_orderkey", "l_linenumber", "label_idx", "features"), fitted)
    return scored.select("l_orderkey", "l_linenumber", "label_idx", models.pred_col("naive_bayes"),
                         F.col(models.pred_col("random_forest")).between(0, k).alias("forest_known_class"))


def _support(per_class):
    """Per model and class that occurs: its rows."""
    return per_class.filter("support > 0").select("model", "class_label", "support")


TRAINED_AND_VOTES = ("naive_bayes", "logistic_regression", "gradient_boosted_trees", "random_forest",
                     "ensemble_hard_vote", "ensemble_soft_vote")


@register("run_experiment", """
SELECT model, l_returnflag AS class_label, count(*) AS support
FROM lineitem, unnest(['naive_bayes', 'logistic_regression', 'random_forest', 'ensemble_hard_vote', 'ensemble_soft_vote']) t(model)
WHERE year(l_shipdate) >= 2000 GROUP BY model, l_returnflag""")
def run_experiment(spark, sf_dir):
    """File split of lineitem flows (days <= 1999 train), multiclass, NB + LR + RF (+ votes)."""
    cfg = ExperimentConfig(mode="multiclass", split="file", sample_fraction=1.0, train_sources=tuple(TRAIN_DAYS),
                           test_sources=tuple(TEST_DAYS), models=("nb", "lr", "rf"))
    flows = lineitem_flows(spark, sf_dir).drop("l_orderkey", "l_linenumber")
    res = run_experiment_plan(flows, cfg)
    res.release()  # the metrics read the confusion table written below the checkpoint folder
    return _support(res.per_class)


@register("run_both_splits", f"""
SELECT 'file' AS split, model, CASE WHEN event_type = 'view' THEN 'normal' ELSE 'attack' END AS class_label, count(*) AS support
FROM events, unnest({list(TRAINED_AND_VOTES)}) t(model) WHERE CAST(ts AS DATE) >= DATE '2024-01-25' GROUP BY ALL
UNION ALL SELECT 'random', 'train and test', 'all', count(*) FROM events""")
def run_both_splits(spark, sf_dir):
    """Binary events (normal = view): random split and file split by day, all four models.

    Of the file split the rows per model and class, of the random split the rows of both parts together.
    """
    days = [f"day-2024-01-{d:02d}" for d in range(1, 31)]
    cfg = ExperimentConfig(mode="binary", normal_label="view", sample_fraction=1.0, train_sources=tuple(days[:24]),
                           test_sources=tuple(days[24:]))
    res = run_both_splits_plan(event_flows(spark, sf_dir).drop("event_id"), cfg)
    out = _support(res["file"].per_class).select(F.lit("file").alias("split"), "model", "class_label", "support")
    both = res["random"].split_summary.agg(F.sum("count").alias("support"))
    for r in res.values():
        r.release()
    return out.unionByName(both.select(F.lit("random").alias("split"), F.lit("train and test").alias("model"), F.lit("all").alias("class_label"), "support"))


@register("run_kdd_experiment", "SELECT 'train and test' AS part, count(*) AS rows FROM lineitem")
def run_kdd_experiment(spark, sf_dir):
    """KDD layout (from lineitem) read from CSV; binary, random split, the dataset's categorical columns, NB + RF."""
    from flowguard.checks.q_sources import write_kdd_file
    from flowguard.plans.experiment import prepare_flows
    from flowguard.sources.flow_csv import KDD_NUMERIC, read_kdd

    cfg = ExperimentConfig(dataset="kdd", mode="binary", split="random", sample_fraction=1.0, fast=True)
    flows = prepare_flows(read_kdd(spark, write_kdd_file(spark, sf_dir)), cfg)
    res = run_experiment_plan(flows, cfg, feature_cols=[*cfg.categorical, *KDD_NUMERIC])
    res.release()
    return res.split_summary.agg(F.sum("count").alias("rows")).select(F.lit("train and test").alias("part"), "rows")


@register("assemble_features", f"""
SELECT l_orderkey, l_linenumber, l_quantity AS f_0, l_extendedprice AS f_1, l_discount AS f_2, l_tax AS f_3
FROM (SELECT *, CASE (l_orderkey + l_linenumber) % 13 WHEN 0 THEN NULL WHEN 1 THEN CAST('NaN' AS DOUBLE)
                ELSE l_tax END AS t FROM lineitem) x WHERE t IS NOT NULL AND NOT isnan(t)""")
def assemble_features(spark, sf_dir):
    """VectorAssembler with skip: rows with a null or NaN feature are dropped."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        F.expr("CASE (l_orderkey + l_linenumber) % 13 WHEN 0 THEN NULL WHEN 1 THEN CAST('NaN' AS DOUBLE) "
               "ELSE l_tax END").alias("l_tax"))
    out = features.assemble_features(li, LINEITEM_FEATURES)
    arr = vector_to_array(F.col("features"))
    return out.select("l_orderkey", "l_linenumber", *[arr[i].alias(f"f_{i}") for i in range(4)])


@register("row_id", "SELECT count(*) AS n_rows, count(*) AS n_ids FROM events")
def row_id(spark, sf_dir):
    """Ids from monotonically_increasing_id are unique: as many distinct ids as rows."""
    ids = features.with_row_id(table(spark, sf_dir, "events").select("event_id"))
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_id").alias("n_ids"))


# Naive Bayes in closed form: class log-priors and per-class feature log-frequencies from the
# training days, one parameter row of per-class lists, argmax (first maximum) per test row.
NB_CTES = f"""{LI_TRAIN},
tot AS (SELECT count(*) AS n_all, (SELECT count(*) FROM lbl) AS k FROM tr),
cls AS (
  SELECT lbl.label_idx, count(*) AS n, sum(f0) AS s0, sum(f1) AS s1, sum(f2) AS s2, sum(f3) AS s3
  FROM tr JOIN lbl ON tr.label = lbl.label GROUP BY lbl.label_idx),
par AS (
  SELECT label_idx, ln(n + 1.0) - ln(n_all + k * 1.0) AS pi, ln(s0 + 1.0) - ln(s0 + s1 + s2 + s3 + 4.0) AS t0,
         ln(s1 + 1.0) - ln(s0 + s1 + s2 + s3 + 4.0) AS t1, ln(s2 + 1.0) - ln(s0 + s1 + s2 + s3 + 4.0) AS t2,
         ln(s3 + 1.0) - ln(s0 + s1 + s2 + s3 + 4.0) AS t3 FROM cls, tot),
par_list AS (
  SELECT list(pi ORDER BY label_idx) AS pis, list(t0 ORDER BY label_idx) AS t0s, list(t1 ORDER BY label_idx) AS t1s,
         list(t2 ORDER BY label_idx) AS t2s, list(t3 ORDER BY label_idx) AS t3s FROM par),
te AS (
  SELECT l_orderkey, l_linenumber, l_returnflag AS label, {SAN.format(x='l_quantity')} AS f0,
         {SAN.format(x='l_extendedprice')} AS f1, {SAN.format(x='l_discount')} AS f2, {SAN.format(x='l_tax')} AS f3
  FROM lineitem WHERE year(l_shipdate) >= 2000),
scores AS (
  SELECT te.*, list_transform(range(len(pis)), lambda i:
           f0 * t0s[i + 1] + f1 * t1s[i + 1] + f2 * t2s[i + 1] + f3 * t3s[i + 1] + pis[i + 1]) AS rs
  FROM te, par_list),
nb_pred AS (
  SELECT s.l_orderkey, s.l_linenumber, coalesce(lbl.label_idx, CAST((SELECT count(*) FROM lbl) AS DOUBLE)) AS label_idx,
         CAST(list_position(rs, list_max(rs)) - 1 AS DOUBLE) AS pred_naive_bayes
  FROM scores s LEFT JOIN lbl ON s.label = lbl.label)"""


ORACLES["score_models"] = f"""WITH {NB_CTES}
SELECT l_orderkey, l_linenumber, label_idx, pred_naive_bayes, true AS forest_known_class FROM nb_pred"""


@register("prediction_slice", f"WITH {NB_CTES}\nSELECT l_orderkey, l_linenumber, label_idx, pred_naive_bayes FROM nb_pred")
def prediction_slice(spark, sf_dir):
    """A fitted model writes its own prediction column (pred_<model>); naive Bayes on the test days."""
    train, test = _lineitem_split(spark, sf_dir)
    prep = features.feature_pipeline(LINEITEM_FEATURES).fit(train)
    train_p = prep.transform(train).select("label_idx", "features")
    nb = models.build_classifier("naive_bayes", ExperimentConfig(class_weights=False)).fit(train_p)
    scored = nb.transform(prep.transform(test).select("l_orderkey", "l_linenumber", "label_idx", "features"))
    return scored.select("l_orderkey", "l_linenumber", "label_idx", models.pred_col("naive_bayes"))


@register("run_experiment_naive_bayes", f"""WITH {NB_CTES},
nb_long AS (SELECT 'naive_bayes' AS model, 0 AS position, label_idx, pred_naive_bayes AS prediction FROM nb_pred),
{metrics_sql("nb").strip()}
SELECT model, accuracy, round(precision, {R}) AS precision, round(recall, {R}) AS recall,
       round(f1_weighted, {R}) AS f1_weighted, round(f1_macro, {R}) AS f1_macro FROM nb_mm""")
def run_experiment_naive_bayes(spark, sf_dir):
    """The whole experiment with naive Bayes only (file split, multiclass): its comparison row."""
    cfg = ExperimentConfig(mode="multiclass", split="file", sample_fraction=1.0, train_sources=tuple(TRAIN_DAYS),
                           test_sources=tuple(TEST_DAYS), models=("nb",))
    flows = lineitem_flows(spark, sf_dir).drop("l_orderkey", "l_linenumber")
    res = run_experiment_plan(flows, cfg)
    res.release()
    return res.comparison.select("model", "accuracy", *[F.round(c, R).alias(c) for c in
                                                         ("precision", "recall", "f1_weighted", "f1_macro")])


@register("run_and_export", f"""WITH {NB_CTES},
nb_long AS (SELECT 'naive_bayes' AS model, 0 AS position, label_idx, pred_naive_bayes AS prediction FROM nb_pred),
{metrics_sql("nb").strip()}
SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1_weighted, 6) AS f1_weighted, round(f1_macro, 6) AS f1_macro,
       (SELECT count(*) FROM lineitem) AS accepted_lines, r.n AS rejected_lines, r.records AS records
FROM nb_mm, (SELECT count(*) AS n, string_agg(s, ' ' ORDER BY s) AS records FROM (
  SELECT 'short,' || l_returnflag || ',' || count(*) || '@' || file AS s
  FROM lineitem, (VALUES ('Monday-WorkingHours.pcap_ISCX.csv'), ('Friday-WorkingHours-Afternoon-DDos.pcap_ISCX.csv')) f(file) GROUP BY l_returnflag, file) u) r""")
def run_and_export(spark, sf_dir):
    """Main entry end to end: capture days named as the 'small' profile -> load -> NB experiment ->
    result files; returns the model comparison as read back from its CSV (training time left out), the
    lines accepted and rejected by the experiment JSON, and the rejected ones (a short line per class in each file)."""
    from flowguard.checks.q_sources import FULL_HEADER, _flows_with_day
    from flowguard.plans.run import run_and_export as run_and_export_plan
    from flowguard.session import scratch_path
    from flowguard.sinks.writers import COMPARISON_SCHEMA, EXPERIMENT_JSON_SCHEMA
    from flowguard.sources import flow_csv

    flows = _flows_with_day(spark, sf_dir)
    data_dir = scratch_path(spark, "cic-small")
    (train_name,), (test_name,) = flow_csv.CICIDS_PROFILES["small"]
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
    flow_csv.write_flow_csv(flows.filter(F.col("year") < 2000).select(cols), f"{data_dir}/{train_name}", FULL_HEADER)
    flow_csv.write_flow_csv(flows.filter(F.col("year") >= 2000).select(cols), f"{data_dir}/{test_name}", FULL_HEADER)
    short = flows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")).select(F.concat_ws(",", F.lit("short"), "l_returnflag", "n").alias("value"))
    nothing = spark.range(0, 100, numPartitions=100).filter("id < 0").select(F.lit("").alias("value"))
    for name in (train_name, test_name):  # behind empty parts, so that the first file still begins with the header
        nothing.unionAll(short.coalesce(1)).write.mode("append").text(f"{data_dir}/{name}")
    cfg = ExperimentConfig(mode="multiclass", data_size="small", sample_fraction=1.0, models=("nb",))
    written = run_and_export_plan(spark, data_dir, scratch_path(spark, "cic-small-out"), cfg)
    back = spark.read.schema(COMPARISON_SCHEMA).option("header", True).csv(written["file"]["model_comparison"])
    record = spark.read.schema(EXPERIMENT_JSON_SCHEMA).json(written["file"]["experiment_results"]).select("accepted_lines", "rejected_lines")
    rejected = spark.read.schema("source_file string, record string").json(written["file"]["rejected_lines"])
    listed = rejected.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("@", "record", "source_file"))), " ").alias("records"))
    return back.drop("train_time_sec").join(F.broadcast(record)).join(F.broadcast(listed))  # one row each
