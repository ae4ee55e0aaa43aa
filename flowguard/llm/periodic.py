"""Periodic run detection (operator 11): stretches of words that repeat with a period.

A run is a stretch of words with smallest period q and at least max(24, 3 * q) words that no
neighbour extends; each of its words occurs three times in it. So a word that occurs less often in
its segment (at first the text) is in no run and splits the segment; the parts are counted again,
until none splits. The segments that stay are scanned for lags. Scan k looks at periods in
(k / 2, k] by the next occurrence of each stretch of k words: inside a run that is one period on,
and no sooner, as a smaller step would be a smaller period. Equal lags in a row are the run. Scans
double k, and a stretch that doesn't recur is in no larger one that does.

Words and stretches are numbered exactly, without hashes. All is done for a chunk of texts at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import small_batches, with_columns

LEAST_WORDS, LEAST_PERIODS = 24, 3
RUN = "struct<start:long,length:long,period:long>"


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each value, occurrences of each value's kind)."""
    _, number, count = np.unique(values, return_inverse=True, return_counts=True)
    return number, count[number]


def surviving(word: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, segment of each) of the words that recursive splitting leaves.

    ``word`` and ``segment`` number the word and the text at each place. Only segments that the
    last turn split are counted again.
    """
    at = np.arange(len(word))
    segment = segment.astype(np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    kinds, fresh = int(word.max(initial=0)) + 1, 0
    while len(at):
        new = np.r_[True, segment[1:] != segment[:-1]]
        part = np.cumsum(new) - 1
        size = np.bincount(part)[part]
        _, often = _numbered(part * kinds + word[at])
        rare = (often < LEAST_PERIODS) | (size < LEAST_WORDS)
        whole = ~(np.bincount(part, rare)[part] > 0)  # segments that nothing splits any more
        if whole.any():
            done.append((at[whole], fresh + part[whole]))
            fresh += int(part[-1]) + 1
        keep = ~rare & ~whole
        piece = np.cumsum(rare | new)  # a rare word and a segment's start begin a new one
        at, segment = at[keep], piece[keep]
    if not done:
        return at, segment
    places, parts = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(places)
    return places[order], parts[order]


def lag_scan(word: np.ndarray, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """(start, length, period) of every run in the surviving segments, by start and period; places as in ``word``."""
    found = [np.zeros((0, 3), np.int64)]
    if not len(at):
        return found[0]
    last = np.r_[segment[1:] != segment[:-1], True]
    end = np.repeat(at[last] + 1, np.diff(np.r_[0, np.flatnonzero(last) + 1]))  # of each place's segment
    number, _ = _numbered(word[at])
    k = 1
    while len(at):
        order = np.lexsort((at, number, end))  # a segment's equal stretches side by side, in order
        same = (number[order][1:] == number[order][:-1]) & (end[order][1:] == end[order][:-1])
        lag = np.zeros(len(at), np.int64)
        lag[order[:-1][same]] = np.diff(at[order])[same]
        recurs = lag > 0
        recurs[order[1:][same]] = True
        hit = np.flatnonzero((lag > k // 2) & (lag <= k))
        if len(hit):
            place, period = at[hit], lag[hit]
            new = np.r_[True, (np.diff(place) != 1) | (np.diff(period) != 0) | (np.diff(end[hit]) != 0)]
            first = np.flatnonzero(new)
            stop = np.r_[first[1:], len(hit)] - 1
            runs = np.stack([place[first], place[stop] - place[first] + k + period[first], period[first]], 1)
            found.append(runs[runs[:, 1] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * runs[:, 2])])
        # stretches of 2k words: both halves recur, and the segment has room for the least run of a larger period
        at, number, end = at[recurs], number[recurs], end[recurs]
        half = np.searchsorted(at, at + k)
        inside = half < len(at)
        inside[inside] = (at[half[inside]] == at[inside] + k) & (at[inside] + 2 * k <= end[inside])
        pair = number[inside] * (int(number.max(initial=0)) + 1) + number[half[inside]]
        at, end = at[inside], end[inside]
        number, _ = _numbered(pair)
        k *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Per text (its words) the (start, length, period) of its runs, by start and then period."""
    kinds: dict[bytes, int] = {}
    word = np.array([kinds.setdefault(w, len(kinds)) for t in texts for w in t], np.int64)
    first = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    runs = lag_scan(word, *surviving(word, np.repeat(np.arange(len(texts)), np.diff(first))))
    at = np.searchsorted(runs[:, 0], first)
    return [runs[lo:hi] - [f, 0, 0] for f, lo, hi in zip(first[:-1], at[:-1], at[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by spaces, of each run only the first period (unless another run needs less)."""
    if len(runs):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
        words = [words[i] for i in kept]
    return b" ".join(words)


def longest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; of ties the smallest start, then period."""
    best = None
    for s, n, q in runs.tolist():
        if best is None or n * best[2] > best[1] * q:  # runs come by start and period
            best = s, n, q
    return best


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", change: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) of every row.

    Words are ``[^\\x20\\x09-\\x0D]+``. runs: start, length and period of each, by start, then period;
    best: the one with the greatest exact length / period (null without runs); collapsed: the words
    that no run repeats, joined by spaces. ``change`` gives other words for a row's id and words.
    Null and empty texts have no words, no runs and the empty text. Each repeated row has its own
    result, other columns are left out, and an empty table gives none. Work is n log n in a text's
    words for any scan; a text is in memory as a whole.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            words = [t.split() if t else [] for t in batch.column(1).cast(pa.binary()).to_pylist()]  # bytes split at these very characters
            if change:
                words = [change(i, w) if w else w for i, w in zip(batch.column(0).to_pylist(), words)]
            found = runs_of(words)
            best = [longest(r) for r in found]
            flat = np.concatenate([np.zeros((0, 3), np.int64), *found])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(r) for r in found])].astype(np.int32)),
                                             pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], fields=list(run_type)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(w) for w in words], pa.int64()), lists,
                pa.array([b and dict(zip(("start", "length", "period"), b)) for b in best], run_type),
                pa.array([collapsed(w, r) for w, r in zip(words, found)], pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "best", "collapsed"])

    return rows.mapInArrow(run, with_columns(rows, ["doc_id"], {"n_words": "long", "runs": f"array<{RUN}>", "best": RUN, "collapsed": "string"}))
