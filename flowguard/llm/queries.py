"""One query per operator over its whole table; ``pipeline`` runs the stages of corpus_pipeline.py."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm import alignment, bpe, decontam, langid, lattice, licenses, licenses_sql, lshforest, periodic, pii, pseudolm, sharding, substring, toxicity
from flowguard.llm.common import held_out, ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run




@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, corpus_pipeline.tokenizer_path(), keep=["doc_id"], digests=True)


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=24)


@query
def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op2_lshforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lshforest.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8)


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pii.learn(docs)
    return pii.find(docs, model).drop("text")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    found = toxicity.find_passages(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


@query
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = langid.learn(docs.filter(~held_out(F.col("doc_id"))))
    named = langid.identify(docs.drop("lang"), profiles)
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query
def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


@query
def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), threshold=0.8)


@query
def op8_pseudolm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudolm.score(table(spark, sf_dir, "documents"))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's periodic tail: every tenth document (by crc32 of its id) repeats p words from word a on."""
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query
def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(table(spark, sf_dir, "documents"), change=planted)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.document_frequency(docs)).drop("places")


ORACLES["op12_licenses"] = licenses_sql.whole_table()


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), corpus_pipeline.tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model"), digests=True)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
