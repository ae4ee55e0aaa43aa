"""Language identification by rank-order n-gram profiles (operator 6).

A profile is the list of most frequent letter n-grams, by rank. A document's profile is compared
to each language's by the out-of-place distance: the sum over the document's n-grams of the
difference of ranks, or the profile length where the language lacks the n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import beside_text, small_batches, texts_of, with_columns

#: Most frequent n-grams (one to three letters, a space marks a word's edge) in a profile.
PROFILE = 400
#: Rows per language, in expectation, that profiles are learned from (drawn by a hash of the id).
SAMPLE = 2000
#: More values of the label column than this are refused: it isn't a language column.
MAX_LANGUAGES = 2000
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]] = True
    return out


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the n-grams of a text, by code. A code packs up to three code points of 21 bits."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, 0x20).astype(np.int64)
    space = points == 0x20
    points = points[~(space & np.r_[False, space[:-1]])]
    if len(points) < 3:  # no letter
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = points == 0x20
    two = points[:-1] << 21 | points[1:]
    three = (two[:-1] << 21 | points[2:])[~space[1:-1]]
    return np.unique(np.concatenate([points[~space], two, three]), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes, most frequent first; ties by code."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Ranks of the n-grams of each language: ``rank[code, language]``, the profile length where it lacks one."""

    def __init__(self, by_language: dict[str, list[int]], size: int = PROFILE):
        self.languages = sorted(by_language)
        self.size = size
        self.codes = np.unique(np.array([c for v in by_language.values() for c in v], np.int64))
        self.rank = np.full((len(self.codes) + 1, len(self.languages)), size, np.int64)
        for k, name in enumerate(self.languages):
            self.rank[np.searchsorted(self.codes, by_language[name]), k] = np.arange(len(by_language[name]))

    def distances(self, text: str) -> np.ndarray | None:
        """Out-of-place distance to each language as a share of the largest; None without a letter."""
        found = ranked(*grams(text), self.size)
        if not len(found) or not self.languages:
            return None
        at = np.searchsorted(self.codes, found)
        at[at == len(self.codes)] = 0
        known = self.codes[at] == found
        rank = self.rank[np.where(known, at, len(self.codes))]
        there = rank < self.size
        away = np.where(there, np.abs(rank - np.arange(len(found))[:, None]), self.size)
        return away.sum(0) / (self.size * len(found))

    def predict(self, text: str) -> tuple[str, float, float]:
        """(language, score, distance): ties go to the first language by name."""
        d = self.distances(text)
        if d is None:
            return UNKNOWN, 0.0, 1.0
        k = int(d.argmin())
        rest = np.delete(d, k)
        second = float(rest.min()) if len(rest) else 1.0
        return self.languages[k], (1 - float(d[k]) / second if second > 0 else 0.0), float(d[k])


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", size: int = PROFILE, sample: int = SAMPLE) -> Profiles:
    """Profiles of the languages of ``docs`` (rows without a language are ignored; none give no profiles)."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id")).filter("lang IS NOT NULL")
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values in the language column")
    if not counts:
        return Profiles({}, size)
    rate = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, sample / r["count"]))]), F.col("lang"))
    drawn = rows.filter(F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(1 << 40)) < rate * float(1 << 40))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            texts = texts_of(batch.column(1))
            for name in sorted(set(names)):
                found = [grams(texts[i]) for i in np.flatnonzero(names == name)]
                codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in found]), len(codes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(n)], names=["lang", "gram", "n"])

    totals = drawn.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_rank = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= size).collect()  # size rows per language
    out: dict[str, list] = {}
    for r in sorted(top, key=lambda r: r["rank"]):
        out.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(out, size)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", prefix: str = "lang_") -> DataFrame:
    """``docs`` with lang_pred, lang_score (0 to 1: how much nearer than the second) and lang_distance (0 to 1).

    A text that is null or has no letter is ``und`` with score 0 and distance 1, as is every text
    if no language was learned. ``prefix`` replaces lang_; input columns of the new names are replaced.
    """
    new = {f"{prefix}pred": "string", f"{prefix}score": "double", f"{prefix}distance": "double"}
    keep = [c for c in docs.columns if c not in new]
    frame, at = beside_text(docs, keep, text)
    schema = with_columns(frame, keep, new)
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in small_batches(batches, at):
            found = [model.predict(t) for t in texts_of(batch.column(at))]
            name, score, away = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(away, pa.float64())],
                                             names=[*batch.schema.names[:width], *new])

    return frame.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """The rows whose language is identified: a text without a letter, or without any n-gram of any profile, goes."""
    named = identify(docs, profiles, prefix="__lang_")
    return named.filter((F.col("__lang_pred") != UNKNOWN) & (F.col("__lang_distance") < 1)).select(*docs.columns)
