"""Masked pseudo-likelihood scoring (operator 8).

A window network sees the tokens on both sides of a masked position and predicts the token there;
a document's score is the sum of the log-probabilities of its tokens, each given its neighbours.

The corpus is counted whole: the most frequent words are symbols of the network, every other word
is the symbol of its shape, and the word given its shape has its share of the corpus counts, however
rare it is: the counts of the commonest words are broadcast, all others are joined to the documents'
words by a shuffle. The network (numpy) is trained in rounds: every partition continues the current weights on its own
documents, each round on its share of the positions, all rounds together on every position of every
document once, and the weights are averaged by the number of
positions, summed in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import Words, chunks, plain_words, text_chunks, with_columns, write_table

SYMBOLS = 256
SHAPES = 32
#: Words whose counts are broadcast; the others' counts are joined. Scores don't depend on it (from the network's words on).
KNOWN_WORDS = 50_000
SIDE, HIDDEN = 2, 16
ROUNDS, BATCH, RATE = 3, 1024, 0.15
PAD = SYMBOLS
#: The softmax has two levels: a symbol's class (its number // INNER), and the symbol within the class.
INNER = 16
OUTER = SYMBOLS // INNER


def shapes(w: Words) -> np.ndarray:
    """0 to 31: the word's length in bytes (up to 16), and whether it begins with a digit."""
    length = np.minimum(w.end - w.start, 16) - 1
    data = np.frombuffer(w.data, np.uint8)
    digit = (data[w.start] >= 48) & (data[w.start] <= 57)
    return length + 16 * digit


class Vocabulary:
    """Symbols of words, and log P(word | symbol): ``inner`` of the known words; of others, the log of their count plus ``other`` of their shape."""

    def __init__(self, top: list[tuple[int, int, int]], rest: dict[int, int]):
        """``top``: (hash, shape, count), most frequent first; ``rest``: per shape the count of the other words."""
        own = SYMBOLS - SHAPES
        hashes = np.array([h for h, _, _ in top], np.int64).view(np.uint64)
        symbol = np.array([k if k < own else own + s for k, (_, s, _) in enumerate(top)], np.int64)
        count = np.array([c for _, _, c in top], float)
        total = np.bincount(symbol, count, SYMBOLS)
        for s, c in rest.items():
            total[own + s] += c
        order = np.argsort(hashes)
        self.hashes, self.symbol = hashes[order], symbol[order]
        self.inner = np.log(count[order] / total[symbol[order]]) if len(top) else np.zeros(0)
        self.other = -np.log(np.maximum(total[own:], 1))

    def read(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols as bytes, log P(word | symbol) but for the log of a rare word's count, whether the word is rare) of each word."""
        shape = shapes(w)
        out, inner, rare = (shape + SYMBOLS - SHAPES).astype(np.uint8), self.other[shape], np.ones(len(shape), bool)
        if len(self.hashes):
            at = np.searchsorted(self.hashes, w.hashes)
            at[at == len(self.hashes)] = 0
            known = self.hashes[at] == w.hashes
            out = np.where(known, self.symbol[at], out).astype(np.uint8)
            inner = np.where(known, self.inner[at], inner)
            rare = ~known
        return out, inner, rare


class Network:
    """tanh of summed neighbour embeddings (a table per relative position), then a softmax over classes of
    symbols and one over the symbols of the target's class: INNER + OUTER exponentials, and their product sums to 1."""

    SHAPES = ((2 * SIDE, SYMBOLS + 1, HIDDEN), (HIDDEN,), (HIDDEN, OUTER), (OUTER,), (OUTER, HIDDEN, INNER), (OUTER, INNER))
    SIZE = sum(int(np.prod(s)) for s in SHAPES)

    def __init__(self, flat: np.ndarray):
        self.flat = flat.astype(np.float32)
        self.parts, at = [], 0
        for s in self.SHAPES:
            n = int(np.prod(s))
            self.parts.append(self.flat[at : at + n].reshape(s))
            at += n

    @classmethod
    def fresh(cls, frequency: np.ndarray, seed: int = 8) -> Network:
        """Small random weights; the output biases start at the log frequencies of classes and symbols."""
        net = cls(np.random.default_rng(seed).normal(0, 0.1, cls.SIZE))
        net.parts[1][:] = 0
        share = ((frequency + 1) / (frequency.sum() + SYMBOLS)).reshape(OUTER, INNER)
        net.parts[3][:] = np.log(share.sum(1))
        net.parts[5][:] = np.log(share / share.sum(1, keepdims=True))
        return net

    def hidden(self, around: np.ndarray) -> np.ndarray:
        table, bias = self.parts[0], self.parts[1]
        h = table[0].take(around[:, 0], 0) + bias
        for k in range(1, 2 * SIDE):
            h += table[k].take(around[:, k], 0)
        return np.tanh(h, out=h)

    def log_probabilities(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        out = np.empty(len(target))
        for lo in range(0, len(target), 4096):
            y = target[lo : lo + 4096]
            h = self.hidden(around[lo : lo + 4096])
            p = _softmax(h @ self.parts[2] + self.parts[3])
            total = np.log(p[np.arange(len(y)), y // INNER].astype(float))
            for c, rows in _by_class(y):
                q = _softmax(h[rows] @ self.parts[4][c] + self.parts[5][c])
                total[rows] += np.log(q[np.arange(len(rows)), y[rows] % INNER].astype(float))
            out[lo : lo + 4096] = total
        return out

    def gradient(self, around: np.ndarray, target: np.ndarray) -> Network:
        """Of the mean negative log-probability of the targets, by every weight."""
        order = np.argsort(target // INNER, kind="stable")  # classes side by side
        around, target = around[order], target[order]
        number, n, every = target // INNER, len(target), np.arange(len(target))
        h = self.hidden(around)
        grad = Network(np.zeros(self.SIZE, np.float32))
        z = _softmax(h @ self.parts[2] + self.parts[3])
        z[every, number] -= 1
        z /= n
        grad.parts[2][:] = h.T @ z
        grad.parts[3][:] = z.sum(0)
        back = z @ self.parts[2].T
        first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        place = target % INNER
        for c, lo, hi in zip(number[first].tolist(), first.tolist(), [*first[1:].tolist(), n]):
            weights, own = self.parts[4][c], h[lo:hi]
            z = _softmax(own @ weights + self.parts[5][c])
            z[every[: hi - lo], place[lo:hi]] -= 1
            z /= n
            grad.parts[4][c] = own.T @ z
            grad.parts[5][c] = z.sum(0)
            back[lo:hi] += z @ weights.T
        back *= 1 - h * h
        grad.parts[1][:] = back.sum(0)
        for k in range(2 * SIDE):
            column = around[:, k]
            order = np.argsort(column.astype(np.uint16), kind="stable")  # 16 bits: a radix sort
            column = column[order]
            first = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
            grad.parts[0][k][column[first]] = np.add.reduceat(back.take(order, 0), first)
        return grad

    def train(self, around: np.ndarray, target: np.ndarray, memory: np.ndarray) -> None:
        """One pass of Adagrad over the examples in batches; ``memory`` holds the squared gradients."""
        for lo in range(0, len(target), BATCH):
            slope = self.gradient(around[lo : lo + BATCH], target[lo : lo + BATCH]).flat
            memory += slope**2
            self.flat -= RATE * slope / np.sqrt(memory)


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def _by_class(target: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(class, the rows whose target is in it)."""
    number = target // INNER
    order = np.argsort(number, kind="stable")
    first = np.r_[0, np.flatnonzero(np.diff(number[order])) + 1, len(order)]
    for lo, hi in zip(first[:-1], first[1:]):
        if hi > lo:
            yield int(number[order[lo]]), order[lo:hi]


def examples(symbols: np.ndarray, first: np.ndarray, pick: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours, target) of the positions ``pick`` (default all) of several texts laid end to end."""
    n = np.diff(first)
    wide = np.full(len(symbols) + SIDE * (len(n) + 1), PAD, np.int64)  # pads between the texts
    at = np.arange(len(symbols)) + SIDE * (1 + np.repeat(np.arange(len(n)), n))
    wide[at] = symbols
    if pick is not None:
        at = at[pick]
    offsets = [k for k in range(-SIDE, SIDE + 1) if k]
    return np.stack([wide[at + k] for k in offsets], 1), wide[at]


def count_words(docs: DataFrame) -> DataFrame:
    """(h, shape, n): occurrences of every word in all of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, texts in text_chunks(batch.column(0)):
                w = plain_words(texts)
                kinds, where, n = np.unique(w.hashes, return_index=True, return_counts=True)
                found.append((kinds, shapes(w)[where], n))
            if found:
                kinds, where, back = np.unique(np.concatenate([f[0] for f in found]), return_index=True, return_inverse=True)
                n = np.bincount(back, np.concatenate([f[2] for f in found]), len(kinds)).astype(np.int64)
                shape = np.concatenate([f[1] for f in found])[where]
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(shape.astype(np.int32)), pa.array(n)], names=["h", "shape", "n"])

    return docs.select("text").mapInArrow(run, "h long, shape int, n long").groupBy("h", "shape").agg(F.sum("n").alias("n"))


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    kinds = counts.count()
    often = counts
    if kinds > KNOWN_WORDS:  # words rarer than the approximate quantile can't be among them: no partition sends its own top list
        share = max(0.0, 1 - KNOWN_WORDS / kinds - 2e-4)
        often = counts.filter(F.col("n") >= counts.agg(F.percentile_approx("n", share, 10_000)).first()[0])
    top = [(r["h"], r["shape"], r["n"]) for r in often.orderBy(F.desc("n"), "h").limit(KNOWN_WORDS).collect()]
    known = {}
    for _, s, n in top:
        known[s] = known.get(s, 0) + n
    sums = counts.groupBy("shape").agg(F.sum("n").alias("n")).collect()  # 32 rows at most
    return Vocabulary(top, {r["shape"]: r["n"] - known.get(r["shape"], 0) for r in sums})


def train(read: DataFrame, rounds: int = ROUNDS) -> Network:
    """Weights after ``rounds`` of training on every document's symbols (column ``symbols``, binary).

    Each round takes every ``rounds``-th position of each document, from a place that follows from the
    document alone: together they take every position once, however the documents are batched.
    """
    spark = read.sparkSession

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8), minlength=SYMBOLS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SYMBOLS)), pa.array(total)], names=["symbol", "n"])

    start = np.zeros(SYMBOLS)
    for r in read.select("symbols").mapInArrow(frequency, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        start[r["symbol"]] = r["n"]
    net = Network.fresh(start)
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(net.flat)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, k=k) -> Iterator[pa.RecordBatch]:
            local = Network(shared.value.copy())
            memory = np.full(Network.SIZE, 1e-4, np.float32)
            seen = 0
            for batch in batches:
                texts = batch.column(0).to_pylist()
                for lo, hi in chunks(map(len, texts), 1 << 18):
                    first = np.r_[0, np.cumsum([len(t) for t in texts[lo:hi]])]
                    symbols = np.frombuffer(b"".join(texts[lo:hi]), np.uint8)
                    shift = np.diff(np.r_[0, np.cumsum(symbols, dtype=np.int64)][first]) - first[:-1]  # mixes the places in a text over the rounds
                    turn = (np.arange(len(symbols)) + np.repeat(shift, np.diff(first))) % rounds
                    around, target = examples(symbols, first, np.flatnonzero(turn == k))
                    local.train(around, target, memory)
                    seen += len(target)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(Network.SIZE)), pa.array(local.flat.astype(float) * seen), pa.array(np.full(Network.SIZE, float(seen)))],
                                                 names=["slot", "total", "n"])

        summed = read.select("symbols").mapInArrow(run, "slot long, total double, n double").groupBy("slot").agg((F.sum("total") / F.sum("n")).alias("w"))
        rows = summed.collect()  # one row per weight of the network
        if not rows:
            break
        flat = net.flat.copy()
        flat[[r["slot"] for r in rows]] = [r["w"] for r in rows]
        net = Network(flat)
    return net


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, per_token) of every row.

    Words are lower-case runs of letters and digits. A text without words (null, empty) has 0
    tokens, log-likelihood 0 and a null per_token. Repeated rows each count in the training.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counts = write_table(count_words(rows), "word-counts")
    vocabulary = docs.sparkSession.sparkContext.broadcast(learn_vocabulary(counts))
    words_kind = pa.list_(pa.struct([("h", pa.int64()), ("times", pa.int64())]))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_chunks(batch.column(2)):
                w = plain_words(texts)
                symbols, inner, rare = vocabulary.value.read(w)
                total = np.r_[0.0, np.cumsum(inner)]
                data = symbols.tobytes()
                owner, kinds, times = _distinct(np.repeat(np.arange(len(texts)), w.counts())[rare], w.hashes[rare])
                others = pa.StructArray.from_arrays([pa.array(kinds.view(np.int64)), pa.array(times)], fields=list(words_kind.value_type))
                first = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(texts)))].astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *[c.slice(lo, hi - lo) for c in batch.columns[:2]], pa.array([data[a:b] for a, b in zip(w.first[:-1], w.first[1:])], pa.binary()),
                    pa.array(total[w.first[1:]] - total[w.first[:-1]]), pa.ListArray.from_arrays(pa.array(first), others)],
                    names=["row", "doc_id", "symbols", "inner", "rare"])

    schema = with_columns(rows, ["row", "doc_id"], {"symbols": "binary", "inner": "double", "rare": "array<struct<h:long,times:long>>"})
    read = write_table(rows.mapInArrow(coded, schema), "symbols")
    net = docs.sparkSession.sparkContext.broadcast(train(read).flat)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network(net.value)
        for batch in batches:
            texts, inner = batch.column(2).to_pylist(), batch.column(3).to_numpy()
            for lo, hi in chunks(map(len, texts), 1 << 17):
                n = np.array([len(t) for t in texts[lo:hi]])
                first = np.r_[0, np.cumsum(n)]
                around, target = examples(np.frombuffer(b"".join(texts[lo:hi]), np.uint8), first)
                total = np.r_[0.0, np.cumsum(model.log_probabilities(around, target))]
                sums = total[first[1:]] - total[first[:-1]] + inner[lo:hi]
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, hi - lo) for c in batch.columns[:2]], pa.array(n.astype(np.int64)), pa.array(np.where(n > 0, sums, 0.0))],
                                                 names=["row", "doc_id", "n_tokens", "sums"])

    known = read.select("row", "doc_id", "symbols", "inner").mapInArrow(scored, with_columns(rows, ["row", "doc_id"], {"n_tokens": "long", "sums": "double"}))
    rare = read.select(F.col("row").alias("of"), F.inline("rare")).join(counts.select("h", "n"), "h").groupBy("of").agg(F.sum(F.col("times") * F.log("n")).alias("more"))
    return known.join(rare, F.col("row") == F.col("of"), "left").withColumn("log_likelihood", F.col("sums") + F.coalesce("more", F.lit(0.0))).select(
        "doc_id", "n_tokens", "log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("per_token"))


def _distinct(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, hash, times): the distinct words of each text, in the order of the texts."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])][: len(owner)])
    return owner[new], hashes[new], np.diff(np.r_[new, len(owner)])
