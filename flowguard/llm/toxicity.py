"""Toxic passages by maximum-scoring segments (operator 4).

A word's score is its log-odds between toxic and other documents under Dirichlet priors spread
by the word's overall frequency, less a small drift. One linear scan (positive scores only, the
rest by prefix sums) finds every maximal-scoring segment of a document. In documents without
toxicity the best of n words' segments follows an extreme-value law: as many as K n exp(-rate x)
segments of score x are expected, where the rate solves E[exp(rate s)] = 1 over the words of such
documents (with the priors, which know the toxic words too) and K is fitted to the sample's. The
law turns segment scores into expected counts, and a logistic curve fitted to the training sample
turns those into a document's score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import Words, chunks, plain_words, texts_of, with_columns

#: Labelled training rows, in expectation, that the model is fitted on (drawn by a hash of the id).
SAMPLE = 20_000
#: Prior weight as a share of all counts, and the drift per word.
PRIOR, DRIFT = 0.1, 0.1
#: Least |z| and |log-odds| of a scored word.
LEAST_Z, LEAST_ODDS = 2.5, 1.0
#: Besides the word itself, its first bytes are scored, for forms that the sample lacks.
STEMS = (5, 6, 7, 8)
#: A segment is significant if fewer than this many as good are expected in a document without toxicity.
SIGNIFICANT = 0.01


def word_keys(w: Words) -> list[np.ndarray]:
    """Hashes of each word, and of its stem where it is longer than that."""
    return [w.hashes, *[w.prefixes(k) for k in STEMS]]


def segments(gains: list[tuple[float, float]], at: list[int]) -> list[tuple[int, int, float]]:
    """(first, end, score): all maximal-scoring segments, in linear time.

    ``at`` are the positions of the words with a positive score; ``gains`` holds for each what the
    words since the one before it take off, and its own score.
    """
    done: list[tuple] = []  # first, end, sum before, sum after, nearest open segment with a smaller sum before
    out: list[tuple] = []
    total = 0.0
    for position, (lost, score) in zip(at, gains):
        left = total - lost
        total = right = left + score
        first = position
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= left:
                j = out[j][4]
            if j < 0:  # the sum is at a new low: nothing open can grow any more
                done += out
                out = [(first, position + 1, left, right, -1)]
                break
            if out[j][3] >= right:
                out.append((first, position + 1, left, right, j))
                break
            first, left = out[j][0], out[j][2]
            del out[j:]
    return [(a, b, right - left) for a, b, left, right, _ in done + out]


class Model:
    """Scores of words and stems, the extreme-value law and the logistic curve."""

    def __init__(self, keys: np.ndarray, scores: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], scores[order]
        self.rate, self.location = 1.0, 0.0
        self.curve = (0.0, 0.0, 0.0)

    def word_scores(self, w: Words) -> np.ndarray:
        """Of the word's own score and its stems' the one furthest from zero; 0 if none is known. Less the drift."""
        out = np.zeros(len(w.hashes))
        if len(self.keys):
            for h in word_keys(w):
                at = np.searchsorted(self.keys, h)
                at[at == len(self.keys)] = 0
                found = np.where(self.keys[at] == h, self.scores[at], 0.0)
                out = np.where(np.abs(found) > np.abs(out), found, out)
        return out - DRIFT

    def scan(self, w: Words) -> list[list[tuple[int, int, float]]]:
        """The maximal segments of each text (word positions within the text)."""
        s = self.word_scores(w)
        total = np.r_[0.0, np.cumsum(s)]
        positive = np.flatnonzero(s > 0)
        bounds = np.searchsorted(positive, w.first)
        out = []
        for d in range(len(w.first) - 1):
            p = positive[bounds[d] : bounds[d + 1]]
            if not len(p):
                out.append([])
                continue
            end = np.r_[w.first[d], p[:-1] + 1]
            gaps = total[end] - total[p]
            out.append(segments(list(zip(gaps.tolist(), s[p].tolist())), (p - w.first[d]).tolist()))
        return out

    def expected(self, score: float, n: int) -> float:
        """How many segments as good are expected by chance among ``n`` words."""
        return math.exp(min(50.0, self.location + math.log(max(n, 1)) - self.rate * score))

    def features(self, found: list[tuple[int, int, float]], n: int) -> tuple[float, float]:
        """(-log expected of the best segment, log of 1 + significant segments)."""
        if not found:
            return 0.0, 0.0
        best = max(s for _, _, s in found)
        # expected(s) < SIGNIFICANT is a bound on s
        least = (self.location + math.log(max(n, 1)) - math.log(SIGNIFICANT)) / self.rate
        return min(60.0, max(0.0, -math.log(self.expected(best, n) + 1e-300))), math.log1p(sum(s > least for _, _, s in found))

    def score(self, features: tuple[float, float]) -> float:
        z = self.curve[0] + self.curve[1] * features[0] + self.curve[2] * features[1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on a sample of the labelled rows (a null label is none; of labels of one id the largest counts).

    Without toxic or without other rows in the sample the model knows no word.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col(doc_id).alias("doc_id"), F.col(toxic).cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = marked.count()
    rate = min(1.0, sample / max(count, 1))
    drawn = marked.filter(F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(1 << 40)) < rate * float(1 << 40))
    # at most about `sample` ids: bounded whatever the table's size
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "toxic")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = texts_of(batch.column(1)), batch.column(2).to_numpy()
            for lo, hi in chunks(map(len, texts)):
                w = plain_words(texts[lo:hi])
                owner = np.repeat(np.arange(hi - lo), w.counts())
                keys = np.concatenate(word_keys(w))
                order = np.lexsort((keys, both := np.tile(owner, 1 + len(STEMS))))
                keys, both = keys[order], both[order]
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (both[1:] != both[:-1])  # a document counts once for a word
                kinds, at = np.unique(keys[new], return_inverse=True)
                yes = np.bincount(at, marks[lo:hi][both[new]] != 0, len(kinds)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(yes), pa.array(np.bincount(at, minlength=len(kinds)) - yes)], names=["key", "yes", "no"])

    counts = rows.mapInArrow(count_words, "key long, yes long, no long").groupBy("key").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    counts = counts.withColumn("n", F.col("yes") + F.col("no")).persist()
    try:
        yes, no = counts.agg(F.sum("yes"), F.sum("no")).first()
        if not yes or not no:
            return Model(np.zeros(0, np.uint64), np.zeros(0))
        weight = PRIOR * (yes + no)
        prior = weight * F.col("n") / (yes + no)
        a, b = F.col("yes") + prior, F.col("no") + prior
        odds = F.log(a / (yes + weight - a)) - F.log(b / (no + weight - b))
        z = odds / F.sqrt(1 / a + 1 / b)
        known = counts.select("key", odds.alias("odds"), (b / (no + weight)).alias("share"), z.alias("z")).filter(
            (F.abs("z") >= LEAST_Z) & (F.abs("odds") >= LEAST_ODDS)).toPandas()  # words of the bounded sample
    finally:
        counts.unpersist()
    model = Model(known["key"].to_numpy().view(np.uint64), known["odds"].to_numpy())
    model.rate = _rate(known["odds"].to_numpy() - DRIFT, known["share"].to_numpy())
    _calibrate(model, rows, spark)
    return model


def _rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of E[exp(rate s)] = 1 for words of these scores and shares; all others score -DRIFT."""
    low, high = 1e-3, 50.0
    for _ in range(100):
        rate = (low + high) / 2
        with np.errstate(over="ignore"):
            mean = (shares * np.exp(rate * scores)).sum() + max(0.0, 1 - shares.sum()) * math.exp(-rate * DRIFT)
        low, high = (rate, high) if mean < 1 else (low, rate)
    return low


def _calibrate(model: Model, rows: DataFrame, spark) -> None:
    """K of the extreme-value law from the sample's other documents, then the logistic curve."""
    found = [r for r in _scanned(rows, model, spark).collect() if r["n"]]  # a row of numbers per sampled document
    null = [(r["best"], r["n"]) for r in found if not r["toxic"]]
    if null:  # the likelihood of P(best <= x) = exp(-K n exp(-rate x)) is largest here
        model.location = math.log(len(null) / sum(n * math.exp(-model.rate * best) for best, n in null))
    x = np.array([[1.0, *model.features([(0, 0, s) for s in r["scores"]], r["n"])] for r in found])
    y = np.array([float(r["toxic"] != 0) for r in found])
    if len(set(y)) < 2:
        return
    w = np.zeros(3)
    ridge = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(3), x.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    model.curve = tuple(map(float, w))


def _scanned(rows: DataFrame, model: Model, spark) -> DataFrame:
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in chunks(map(len, texts)):
                w = plain_words(texts[lo:hi])
                scores = [[s for _, _, s in found] for found in shared.value.scan(w)]
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(lo, hi - lo), pa.array(w.counts().astype(np.int64)),
                                                  pa.array([max(s, default=0.0) for s in scores], pa.float64()), pa.array(scores, pa.list_(pa.float64()))],
                                                 names=["toxic", "n", "best", "scores"])

    return rows.mapInArrow(run, "toxic int, n long, best double, scores array<double>")


def find_passages(docs: DataFrame, model: Model, text: str = "text", passages: bool = True) -> DataFrame:
    """``docs`` with score, predicted and passages (significant ones: first_word, end_word, score, expected).

    Null and empty texts get the score of a document without a positive word. Words are counted
    from 0; input columns of the new names are replaced.
    """
    kind = "array<struct<first_word:int,end_word:int,score:double,expected:double>>"
    new = {"score": "double", "predicted": "int"} | ({"passages": kind} if passages else {})
    keep = [c for c in docs.columns if c not in new]
    frame = docs.select(*keep, F.col(text).alias("__text"))
    schema = with_columns(frame, keep, new)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    arrow_kind = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = texts_of(batch.column(batch.num_columns - 1))
            score: list[float] = []
            spans: list[list] = []
            for lo, hi in chunks(map(len, texts)):
                w = plain_words(texts[lo:hi])
                for found, n in zip(m.scan(w), w.counts().tolist()):
                    score.append(m.score(m.features(found, n)))
                    if passages:
                        spans.append([(a, b, s, e) for a, b, s in found if (e := m.expected(s, n)) < SIGNIFICANT])
            cols = [pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32())]
            if passages:
                cols.append(pa.array([[dict(zip(("first_word", "end_word", "score", "expected"), x)) for x in s] for s in spans], arrow_kind))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], names=[*batch.schema.names[:-1], *new])

    return frame.mapInArrow(run, schema)
