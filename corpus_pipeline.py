"""A training-data pipeline over ``documents``: five stages, each written as Parquet and reread as the next one's input.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the
last return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm import bpe, decontam, langid, lshforest, pii
from flowguard.llm.common import ship, table, write_table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def stage(fn):
    """A stage whose code the executors have."""

    @wraps(fn)
    def shipped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, docs, sf_dir)

    return shipped


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified stay (operator 6): a text without a letter, or unlike every language, goes."""
    return langid.keep_identified(docs, langid.learn(docs))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays (operator 2)."""
    return lshforest.keep_one(docs, threshold=0.8)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go (operator 5)."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"), threshold=0.8)


@stage
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by the name of its kind (operator 3); n_chars follows."""
    found = pii.find(docs, pii.learn(docs), mask="text", prefix="__")
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


@stage
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the text they decode to (operator 10)."""
    coded = bpe.encode_decode(docs, tokenizer_path(), keep=["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", "n_tokens", "token_ids", F.sha2(F.concat_ws(",", "token_ids"), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", mask_personal_data),
    ("BPE encoding and decoding", tokenize),
]

#: MinHash, rank-order profiles and BPE have no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; each result is a table in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = write_table(apply(spark, docs, sf_dir), f"stage-{name.replace(' ', '-').lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
