"""The given parquet tables and the flow stand-ins derived from them (FIXTURES.md section 5).

Every stand-in is a projection (or, for documents, one join) over a whole table, so its
work grows with the data. Parquet scans get column pruning and filter pushdown for free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.functions.exprs import label_index_expr
from flowguard.operators.features import label_counts

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EVENT_FEATURES = ["value", "k", "hour"]
DOCUMENT_FEATURES = ["n_chars", "text_len", "n_words", "n_lines"]
# Rule predictors on events: model name -> (prediction column, probability column).
RULES = {"rule_a": ("pred_rule_a", "prob_rule_a"), "rule_b": ("pred_rule_b", "prob_rule_b"),
         "rule_c": ("pred_rule_c", "prob_rule_c")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-class flows: label = return flag, 4 numeric features, source = ship year as a 'day' file."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", *LINEITEM_FEATURES,
        F.col("l_returnflag").alias("label"),
        F.concat(F.lit("day-"), F.year("l_shipdate").cast("string"), F.lit(".csv")).alias("source_file"),
    )


def event_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-class keyed flows: label = event type, features value, k (from JSON props), hour; source = day."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour"),
        F.col("event_type").alias("label"),
        F.concat(F.lit("day-"), F.to_date("ts").cast("string")).alias("source_file"),
    )


def embedding_features(spark: SparkSession, sf_dir: str) -> list[str]:
    """One feature name per element of the vectors; vectors of different widths are an error."""
    size = F.size("embedding")
    low, high = table(spark, sf_dir, "embeddings").agg(F.min(size), F.max(size)).first()
    if low != high:
        raise ValueError(f"embeddings of {low} to {high} elements")
    return [f"e_{i}" for i in range(high or 0)]


def embedding_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-class flows: one float feature per vector element (negatives present), label 0-9 as text."""
    em = table(spark, sf_dir, "embeddings")
    return em.select(
        "vec_id",
        *[F.get("embedding", i).cast("double").alias(name) for i, name in enumerate(embedding_features(spark, sf_dir))],
        F.col("label").cast("string").alias("label"),
    )


def document_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary, unbalanced flows: documents joined with quality labels; text-length features."""
    docs = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    joined = docs.join(lab.select("doc_id", "quality"), "doc_id", "inner")
    return joined.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.length("text").cast("double").alias("text_len"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        "lang",
        F.col("quality").cast("string").alias("label"),
        F.col("source").alias("source_file"),
    )


def _one_hot(pred, length: int, hit: float, other: float):
    """Probability array of ``length`` with ``hit`` at the predicted index, ``other`` elsewhere."""
    p = pred.cast("int")
    return F.array(*[F.when(p == i, F.lit(hit)).otherwise(F.lit(other)) for i in range(length)])


def event_labels(spark: SparkSession, sf_dir: str) -> list[str]:
    """Event-type names in index order: one aggregation, one row per class to the driver."""
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("label"))
    return [label for label, _ in label_counts(ev, "label")]


def event_rule_predictions(spark: SparkSession, sf_dir: str, labels: list[str] | None = None) -> DataFrame:
    """Events with ``label_idx`` and three rule-based 'classifiers' (predictions + probabilities).

    a: 0/1/2 by value < 50 / < 150 / else (3 classes); b: event_id % 6 (class 5 is no label);
    c: abstains (null) when event_id % 50 = 7, else user_id % 5. Probabilities are dyadic
    one-hot-like arrays of different lengths (3, 6, 5), so soft votes are exact. The label
    index comes from the fitted label list as a literal lookup (no join with the events).
    """
    labels = event_labels(spark, sf_dir) if labels is None else labels
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.col("event_type").alias("label"))
    ev = ev.withColumn("label_idx", label_index_expr(F.col("label"), labels))
    a = F.when(F.col("value") < 50, 0).when(F.col("value") < 150, 1).otherwise(2).cast("double")
    b = (F.col("event_id") % 6).cast("double")
    c = F.when(F.col("event_id") % 50 == 7, F.lit(None)).otherwise(F.col("user_id") % 5).cast("double")
    return ev.select(
        "event_id", "label", "label_idx",
        a.alias("pred_rule_a"), b.alias("pred_rule_b"), c.alias("pred_rule_c"),
    ).select(
        "*",
        _one_hot(F.col("pred_rule_a"), 3, 0.5, 0.25).alias("prob_rule_a"),
        _one_hot(F.col("pred_rule_b"), 6, 0.375, 0.125).alias("prob_rule_b"),
        F.when(F.col("pred_rule_c").isNull(), F.lit(None).cast("array<double>"))
        .otherwise(_one_hot(F.col("pred_rule_c"), 5, 0.5, 0.125)).alias("prob_rule_c"),
    )
