"""Repeated passages by difference-cover anchors (operator 7).

Anchors are windows of ANCHOR words at the positions whose remainder modulo PERIOD lies in a
difference cover. Of any two equal passages of WINDOW words, whatever their positions, some
offset below PERIOD is a cover position in both, so they share an aligned anchor there. Anchors
that occur in two documents are extended to the passages around them: only windows that contain
such an anchor are hashed whole and compared, by the smallest document of each window.

A document that equals a smaller one word by word is found by one anchor over all its words.
Groups are aggregated before shuffling and joined back, so a hot passage costs no single task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import Words, drop_table, mix, numbers, release, text_chunks, words, write_table

WINDOW = 50
PERIOD = 31
#: Every remainder modulo 31 is a difference of two of these.
COVER = (0, 1, 3, 8, 12, 18)
ANCHOR = WINDOW - PERIOD + 1


class Rolling:
    """Hashes of runs of words: equal runs have equal hashes wherever they are."""

    BASE = np.uint64(0xD1342543DE82EF95)

    def __init__(self, w: Words):
        n = len(w.hashes) + 1
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.r_[np.ones(1, np.uint64), np.full(n, self.BASE)], dtype=np.uint64)
            inverse = np.uint64(pow(int(self.BASE), -1, 1 << 64))
            self.inverse = np.cumprod(np.r_[np.ones(1, np.uint64), np.full(n, inverse)], dtype=np.uint64)
            self.total = np.r_[np.zeros(1, np.uint64), np.cumsum(w.hashes * self.power[: n - 1], dtype=np.uint64)]

    def of(self, start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[end] - self.total[start]) * self.inverse[start] ^ np.uint64(salt)).view(np.int64)


def anchors(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, position) of the anchors of texts that have a window; position -1: of all words."""
    long = np.flatnonzero(w.counts() >= WINDOW)
    first, n = w.first[long], w.counts()[long]
    roll = Rolling(w)
    doc = np.repeat(long, n - ANCHOR + 1)
    pos = np.arange(len(doc)) - np.repeat(np.r_[0, np.cumsum(n - ANCHOR + 1)][:-1], n - ANCHOR + 1)
    sel = np.isin(pos % PERIOD, COVER)
    doc, pos = doc[sel], pos[sel]
    at = w.first[doc] + pos
    return (np.concatenate([roll.of(at, at + ANCHOR, 1), roll.of(first, first + n, 2)]), np.concatenate([doc, long]),
            np.concatenate([pos, np.full(len(long), -1)]))


def around(positions: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of an n-word text that contain one of the anchors within their first PERIOD words."""
    change = np.zeros(n - WINDOW + 2, np.int64)
    last = n - WINDOW
    lo, hi = np.maximum(positions - PERIOD + 1, 0), np.minimum(positions, last)
    ok = lo <= hi
    np.add.at(change, lo[ok], 1)
    np.add.at(change, hi[ok] + 1, -1)
    return np.flatnonzero(np.cumsum(change)[:-1] > 0)


def covered(starts: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return np.cumsum(change)[:-1] > 0


def _shared(rows: DataFrame) -> DataFrame:
    """(h, least): the hashes that occur in two documents and the smallest of these; written, so that Spark can split the join with it."""
    ends = rows.groupBy("h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    return write_table(ends.filter("least < most").select("h", "least"), "shared-hashes")


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, mark, text); ``mark`` tells the texts of an id that repeats apart."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, mark, whole, starts): texts with words to remove; ``whole``: all of them, else the starts of repeated windows."""
    rows = _rows(docs, doc_id, text).filter("doc_id IS NOT NULL AND text IS NOT NULL")

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, texts in text_chunks(batch.column(2)):
                h, doc, pos = anchors(words(texts))
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ids[lo:hi][doc]), pa.array(marks[lo:hi][doc]), pa.array(pos.astype(np.int32))],
                                                 names=["h", "doc_id", "mark", "pos"])

    found = write_table(rows.mapInArrow(anchored, "h long, doc_id long, mark long, pos int"), "anchors")
    shared = _shared(found)
    # of a whole-text anchor only the later copies are of use: their words all go, and their windows begin in the first copy too
    hits = found.join(shared, "h").filter("pos >= 0 OR doc_id > least").groupBy("doc_id", "mark").agg(
        (F.min("pos") < 0).alias("whole"), F.collect_list("pos").alias("positions"))
    hits = write_table(hits.withColumn("positions", F.when(F.col("whole"), F.array().cast("array<int>")).otherwise(F.col("positions"))), "anchor-hits")
    drop_table(found)
    release(docs.sparkSession)

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            flat, at = numbers(batch.column(3), np.int64)
            for lo, hi, texts in text_chunks(batch.column(2)):
                w = words(texts)
                n = w.counts()
                starts = [around(flat[at[lo + d] : at[lo + d + 1]], n[d]) if n[d] >= WINDOW else np.zeros(0, np.int64) for d in range(hi - lo)]
                doc = np.repeat(np.arange(hi - lo), list(map(len, starts)))
                pos = np.concatenate(starts)
                begin = w.first[doc] + pos
                yield pa.RecordBatch.from_arrays([pa.array(Rolling(w).of(begin, begin + WINDOW, 3)), pa.array(ids[lo:hi][doc]), pa.array(marks[lo:hi][doc]),
                                                  pa.array(pos.astype(np.int32))], names=["h", "doc_id", "mark", "pos"])

    wide = rows.join(hits.filter("NOT whole").select("doc_id", "mark", "positions"), ["doc_id", "mark"]).select("doc_id", "mark", "text", "positions")
    windows = write_table(wide.mapInArrow(extended, "h long, doc_id long, mark long, pos int"), "windows")
    release(docs.sparkSession)
    shared = _shared(windows)
    later = windows.join(shared, "h").filter("doc_id > least").groupBy("doc_id", "mark").agg(F.collect_list("pos").alias("starts"))
    out = later.select("doc_id", "mark", F.lit(False).alias("whole"), "starts").unionAll(
        hits.filter("whole").select("doc_id", "mark", "whole", F.col("positions").alias("starts")))
    out = write_table(out, "repeated")
    drop_table(windows)
    drop_table(hits)
    release(docs.sparkSession)
    return out


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of each row: without the words of passages that a smaller document has.

    Words are runs outside [\\x20\\x09-\\x0D]; a passage is a window of 50. Windows are judged on the
    input. A null text has no words; a row without an id loses nothing and is no source; rows that
    repeat an id are one document, whose texts are each judged against smaller documents alone. kept_text: the kept words,
    joined by a space; ``digest``: kept_sha256 instead.
    """
    gone = repeated(docs, doc_id, text).withColumnsRenamed({"doc_id": "__id", "mark": "__mark"})
    rows = _rows(docs, doc_id, text)
    wide = rows.join(gone, (F.col("doc_id") == F.col("__id")) & (F.col("mark") == F.col("__mark")), "left").select("doc_id", "text", F.coalesce("whole", F.lit(False)), F.coalesce("starts", F.array().cast("array<int>")))
    last = "kept_sha256" if digest else "kept_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(2).to_pylist()
            flat, at = numbers(batch.column(3), np.int64)
            for lo, hi, texts in text_chunks(batch.column(1)):
                w = words(texts)
                n = w.counts()
                removed, kept = np.zeros(hi - lo, np.int64), []
                for d in range(hi - lo):
                    a, b = w.first[d], w.first[d + 1]
                    off = np.ones(n[d], bool) if whole[lo + d] else covered(s[s + WINDOW <= n[d]], n[d]) if len(s := flat[at[lo + d] : at[lo + d + 1]]) else np.zeros(n[d], bool)
                    removed[d] = off.sum()
                    stay = np.flatnonzero(~off) + a
                    words_ = b" ".join([w.data[s:e] for s, e in zip(w.start[stay].tolist(), w.end[stay].tolist())])
                    kept.append(hashlib.sha256(words_).hexdigest() if digest else words_.decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(removed), pa.array(kept, pa.string())],
                                                 names=["doc_id", "n_words", "n_removed", last])

    return wide.mapInArrow(run, f"doc_id long, n_words long, n_removed long, {last} string")
