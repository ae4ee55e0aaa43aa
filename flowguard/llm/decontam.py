"""Benchmark decontamination by size-partitioned MinHash containment search (operator 5).

Test items are partitioned by the number u (a power of two) that their shingles fit in. For a
partition, documents are searched in windows of 2u consecutive shingles, u apart, so a passage of
an item lies in one window whole and the window's similarity to the item is bounded below by the
partition's sizes, however long the document is. An item and a document are candidates if a
window and the item share the minimum of some hash; the number of hashes follows from that bound.
Items that fill less than half of the smallest partition are looked up by their shingles instead.
Candidates are verified by the exact share of the item's shingles that the document has.

The benchmark's items are taken in blocks of bounded size, each of which passes over all
documents; documents aren't shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import CHUNK_CHARS, beside_text, least, permutations, plain_words, shingles, small_batches, texts_of, with_columns

#: Bytes of item text that a pass over the documents takes (expected; one item is never divided).
BLOCK_BYTES = 4 << 20
SMALLEST = 16
#: A contained item is missed with this probability at most, if its passage is contiguous.
MISS = 1e-6


def hashes_needed(threshold: float) -> int:
    """Hashes for an item that half fills its partition, in a window of four times its size."""
    similarity = threshold / (4 + 1 - threshold)
    return math.ceil(math.log(MISS) / math.log(1 - similarity))


class Items:
    """Shingle sets and MinHashes of a block of test items, by size partition."""

    def __init__(self, rows: list[tuple[int, str]], threshold: float, seed: int = 5):
        rows = [r for r in rows if r[0] is not None]
        self.ids = [i for i, _ in rows]
        values, first = shingles(plain_words([t or "" for _, t in rows]), short=False)
        self.sets = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:])]
        self.seeds = permutations(hashes_needed(threshold), seed)
        self.threshold = threshold
        size = np.array([len(s) for s in self.sets], int)
        fits = np.array([max(SMALLEST, 1 << max(0, int(n) - 1).bit_length()) for n in size], int)
        self.partitions: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        hashed = size >= SMALLEST // 2
        few = [(x, k) for k in np.flatnonzero((size > 0) & ~hashed) for x in self._telling(k)]
        few.sort()
        self.short = np.array([x for x, _ in few], np.uint64), np.array([k for _, k in few], int)
        for u in np.unique(fits[hashed]).tolist():
            which = np.flatnonzero((fits == u) & hashed)
            mins = least(np.concatenate([self.sets[k] for k in which]), np.r_[0, np.cumsum(size[which])], self.seeds)
            order = np.argsort(mins, axis=0, kind="stable")  # per hash: items by their minimum
            self.partitions[u] = which, order, np.take_along_axis(mins, order, 0)

    def _telling(self, k: int) -> np.ndarray:
        """Shingles of item ``k``, one of which every text that contains it has: one more than a text may lack."""
        n = len(self.sets[k])
        return self.sets[k][: n - math.ceil(self.threshold * n - 1e-9) + 1]

    def found(self, texts: list[str]) -> list[list[tuple[int, float]]]:
        """(item id, containment) of the items that each text contains, by item id."""
        out: list[list[tuple[int, float]]] = [[] for _ in texts]
        if not self.partitions and not len(self.short[0]):
            return out
        values, first = shingles(plain_words(texts), short=False)
        n = np.diff(first)
        if not n.sum():
            return out
        pairs = self._short(values, first)
        top = max(self.partitions, default=0)
        u, blocks, mins = SMALLEST, *(self._blocks(values, first, n) if top else (None, None))
        while u <= top:
            if u in self.partitions:
                pairs |= self._candidates(u, blocks, mins)
            if u == top:
                break
            starts = np.r_[0, np.cumsum(blocks)]
            halves = (blocks + 1) // 2
            pos = np.arange(halves.sum()) - np.repeat(np.r_[0, np.cumsum(halves)][:-1], halves)
            mins = np.minimum.reduceat(mins, np.repeat(starts[:-1], halves) + 2 * pos, axis=0)
            blocks, u = halves, 2 * u
        last, have = -1, None
        for d, k in sorted(pairs):
            if d != last:
                last, have = d, np.unique(values[first[d] : first[d + 1]])
            share = np.isin(self.sets[k], have, assume_unique=True).sum() / len(self.sets[k])
            if share >= self.threshold - 1e-12:
                out[d].append((self.ids[k], float(share)))
        return [sorted(x) for x in out]

    def _short(self, values, first) -> set[tuple[int, int]]:
        """(text, item) of the short items one of whose telling shingles the text has."""
        keys, item = self.short
        if not len(keys):
            return set()
        lo = np.searchsorted(keys, values)
        hit = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == values)
        owner = np.searchsorted(first, hit, "right") - 1
        seen = np.unique(np.stack([owner, lo[hit]], 1), axis=0)
        ends = np.searchsorted(keys, keys[seen[:, 1]], "right")
        return {(int(d), int(k)) for (d, a), b in zip(seen, ends) for k in item[a:b]}

    def _blocks(self, values, first, n) -> tuple[np.ndarray, np.ndarray]:
        """Blocks per text, and the minima of each block of SMALLEST consecutive shingles."""
        blocks = -(-n // SMALLEST)
        pos = np.arange(blocks.sum()) - np.repeat(np.r_[0, np.cumsum(blocks)][:-1], blocks)
        start = np.repeat(first[:-1], blocks) + SMALLEST * pos
        return blocks, least(values, np.r_[start, len(values)], self.seeds)

    def _candidates(self, u: int, blocks, mins) -> set[tuple[int, int]]:
        which, order, known = self.partitions[u]
        owner = np.repeat(np.arange(len(blocks)), blocks)
        window = mins.copy()
        same = np.flatnonzero(owner[:-1] == owner[1:])
        window[same] = np.minimum(mins[same], mins[same + 1])
        out: set[tuple[int, int]] = set()
        for h in range(mins.shape[1]):
            lo = np.searchsorted(known[:, h], window[:, h], "left")
            hit = np.flatnonzero((lo < len(known)) & (known[np.minimum(lo, len(known) - 1), h] == window[:, h]))
            for w in hit:
                k = lo[w]
                while k < len(known) and known[k, h] == window[w, h]:
                    out.add((int(owner[w]), int(which[order[k, h]])))
                    k += 1
        return out


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about BLOCK_BYTES, one at a time on the driver."""
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = max(1, math.ceil(size / BLOCK_BYTES))
    for b in range(count if size else 0):
        part = rows if count == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b)
        yield sorted((r["item_id"], r["text"]) for r in part.distinct().collect())


def mark(docs: DataFrame, items: DataFrame, threshold: float = 0.8, text: str = "text", column: str = "contained_items") -> DataFrame:
    """``docs`` with an array of (item_id, containment) of the items whose shingles the text has, from ``threshold`` on.

    Shingles are five lower-cased words of letters and digits. Items with fewer words, null texts
    and items without an id are contained in nothing; null and empty texts contain nothing. Items
    that repeat an id count each. An input column of the new name is replaced.
    """
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("containment", pa.float64())]))
    keep = [c for c in docs.columns if c != column]
    out = docs.select(*keep).withColumn(column, F.array().cast("array<struct<item_id:long,containment:double>>"))
    width = len(keep)
    for rows in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(Items(rows, threshold))
        frame, at = beside_text(out, [*keep, column], text)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, at=at) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in small_batches(batches, at, CHUNK_CHARS):
                before = batch.column(width).to_pylist()
                now = block.found(texts_of(batch.column(at)))
                both = [[*(b or []), *({"item_id": i, "containment": c} for i, c in x)] for b, x in zip(before, now)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(both, kind)], names=[*batch.schema.names[:width], column])

        out = frame.mapInArrow(run, with_columns(frame, keep, {column: "array<struct<item_id:long,containment:double>>"}))
    return out


def pairs(docs: DataFrame, items: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, containment): one row per document and item it contains."""
    marked = mark(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), items, threshold)
    return marked.select("doc_id", F.inline("contained_items")).groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment"))


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    return mark(docs, items, threshold, column="__items").filter(F.size("__items") == 0).select(*docs.columns)
