"""N-gram Jaccard join by a MinHash LSH forest (operator 2).

A text's word shingles give a signature of ``trees`` x ``depth`` MinHash values. Each tree is a
trie of its part of the signatures. Two texts are candidates if they share a prefix in some tree;
prefixes are shortened down to the depth at which a pair at the threshold meets in some tree with
the target recall (``Forest.floor``). That depth depends on the threshold alone: very similar copies, which meet
at any depth, can't make up for missed pairs near the threshold.

The subtrees below that depth are the units of work. A task sorts a subtree's signatures, links
the texts that share the longest prefixes first, and shortens node by node: at each node only
texts outside the largest group linked so far are compared with the others, by the agreement of
their whole signatures (kept to a byte a value). A pair at the threshold fails that test with
``Forest.miss`` at most; texts that only share a template do fail it, and form no groups.

Texts linked so are verified exactly: within a group they are dealt to blocks of bounded bytes,
blocks are compared two by two in a task, and the Jaccard similarity of every pair that meets in
some tree is computed from the shingle sets. A task returns a row per text and block (links
counted, smallest linked id), never pairs. Texts with equal shingle sets are one text with a count.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import (
    Tally,
    components,
    least,
    linked_minima,
    mix,
    numbers,
    permutations,
    shingles,
    sifted,
    text_chunks,
    tiles,
    whole_groups,
    words,
    write_table,
)


@dataclass(frozen=True)
class Forest:
    trees: int = 16
    depth: int = 8
    recall: float = 0.999
    miss: float = 1e-6
    seed: int = 2
    node: int = 4096  # texts of a subtree that are sorted together; a larger subtree's are compared part by part
    block: int = 2048  # texts of a block: each text goes to a task for each block of its group
    shingles: int = 1 << 20  # shingles of a block (8 MB), if its texts are long
    tile: int = 1024  # texts of a tile: the blocks of a task are compared tile by tile

    def found(self, similarity: float, depth: int) -> float:
        """Probability that a pair of this similarity meets at ``depth`` in some tree."""
        return 1 - (1 - similarity**depth) ** self.trees

    def floor(self, threshold: float) -> int:
        """The longest prefix at which a pair at the threshold is found with the target recall (1 if none is)."""
        return next((k for k in range(self.depth, 1, -1) if self.found(threshold, k) >= self.recall), 1)

    def agreeing(self, threshold: float) -> int:
        """Values of the signature that agree in a pair at the threshold, but for a chance of ``miss``."""
        n, below = self.trees * self.depth, 0.0
        for k in range(n + 1):
            below += math.comb(n, k) * threshold**k * (1 - threshold) ** (n - k)
            if below > self.miss:
                return k
        return n


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the sorted distinct shingles of each text, lower-cased words of [^\\x20\\x09-\\x0D]."""
    hashes, first = shingles(words([t.lower() for t in texts]))
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.r_[0, np.cumsum(np.bincount(owner[new], minlength=len(texts)))]


def near_duplicates(docs: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text", forest: Forest = Forest()) -> DataFrame:
    """(doc_id, n_links, class_id, kept): links to other rows with Jaccard >= threshold, and the smallest doc_id of the class.

    Shingles are five lower-cased words; a text of one to four words has one shingle of them all.
    Texts without words (null, empty, white space) have no links and are classes of their own, and
    so is a row without an id. Rows of one id and equal shingles count as one row; rows that repeat
    an id with another text are rows of their own. kept: the row is one that stays of its class.
    """
    signed, linked = _classes(docs, threshold, doc_id, text, forest)
    alone = signed.filter("doc_id IS NULL OR n = 0").select("doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"),
                                                            F.lit(True).alias("kept")).distinct()
    return linked.drop("k1", "k2").unionAll(alone)


def keep_one(docs: DataFrame, threshold: float = 0.8, forest: Forest = Forest()) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the document with the smallest doc_id stays.

    Rows without an id or without words stay, and rows of the class that repeat the id that stays
    are one document and stay. Rows that repeat an id with another text are judged by their text.
    """
    signed, linked = _classes(docs, threshold, "doc_id", "text", forest)
    gone = signed.join(linked.filter("NOT kept").select("doc_id", "k1", "k2"), ["doc_id", "k1", "k2"], "left_semi")
    gone = write_table(gone.select(F.col("doc_id").alias("__gone"), F.col("mark").alias("__mark")).distinct(), "text-gone")
    told = sifted(docs, [F.col("doc_id").cast("long"), _mark(F.col("text"))], gone)
    left = told.filter("__may").join(gone, (F.col("doc_id") == F.col("__gone")) & (_mark(F.col("text")) == F.col("__mark")), "left_anti")
    return told.filter("NOT __may").unionAll(left).drop("__may")


def _mark(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _classes(docs: DataFrame, threshold: float, doc_id: str, text: str, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and (doc_id, k1, k2, n_links, class_id, kept) of each id and shingle set."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    signed = write_table(_signatures(rows, forest, forest.floor(threshold)), "signatures")
    marked = write_table(signed.filter("doc_id IS NOT NULL AND n > 0").select("doc_id", "k1", "k2").distinct(), "text-keys")
    # A shingle set is named by the smallest id whose first set it is: no two have the same. One that is
    # no id's first (only of ids that repeat) is named by a hash below the ids.
    first = marked.groupBy("doc_id").agg(F.min(F.struct("k1", "k2")).alias("first"))
    named = marked.join(first, "doc_id").withColumn("own", F.when(F.col("first") == F.struct("k1", "k2"), F.col("doc_id")))
    kinds = named.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.min("own").alias("own"))
    kinds = kinds.select("k1", "k2", "rep", "copies", F.coalesce("own", -F.shiftrightunsigned(F.xxhash64("k1", "k2"), 1) - 1).alias("id"))
    kinds = write_table(kinds.join(signed.select(F.col("doc_id").alias("rep"), "k1", "k2", "n", "nodes", "sketch"), ["rep", "k1", "k2"]).groupBy("k1", "k2").agg(
        *[F.first(c).alias(c) for c in ("id", "rep", "copies", "n", "nodes", "sketch")]), "text-kinds")
    groups = components(_candidates(kinds, threshold, forest), "candidates")
    groups = write_table(groups.join(kinds.drop("sketch"), "id"), "candidate-groups")
    found = write_table(_verify(rows, groups, threshold, forest), "text-links")
    links = found.groupBy("id").agg(F.sum("n").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")), "texts")
    alike = kinds.select("id", "rep").join(roots, "id")
    least = alike.groupBy("component").agg(F.min("rep").alias("class_id"))
    own = (kinds.select("k1", "k2", "id", "rep", "copies").join(links, "id", "left").join(alike.join(least, "component").select("id", "class_id"), "id", "left")
           .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("class_id", "rep").alias("class_id")))
    return signed, marked.join(own, ["k1", "k2"]).select("doc_id", "k1", "k2", "n_links", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def _signatures(rows: DataFrame, forest: Forest, floor: int) -> DataFrame:
    """(doc_id, mark, n, k1, k2, nodes, sketch): shingles and their fingerprint, the text's node at ``floor`` in each tree, its signature a byte a value."""
    seeds = permutations(forest.trees * forest.depth, forest.seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_chunks(batch.column(1)):
                hashes, first = shingle_sets(texts)
                n = np.diff(first)
                mins = mix(least(hashes, first, seeds))
                nodes = np.empty((len(n), forest.trees), np.uint64)
                with np.errstate(over="ignore"):
                    for tree in range(forest.trees):
                        h = np.full(len(n), tree + 1, np.uint64)
                        for k in range(floor):
                            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + mins[:, tree * forest.depth + k])
                        nodes[:, tree] = h
                sketch = (mins >> np.uint64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(n.astype(np.int64)), *map(pa.array, _fingerprint(hashes, first)),
                    pa.FixedSizeListArray.from_arrays(pa.array(nodes.view(np.int64).ravel()), forest.trees).cast(pa.list_(pa.int64())),
                    pa.array([row.tobytes() for row in sketch], pa.binary())], names=["doc_id", "mark", "n", "k1", "k2", "nodes", "sketch"])

    return rows.select("doc_id", "text", _mark(F.col("text")).alias("mark")).mapInArrow(
        run, "doc_id long, mark long, n long, k1 long, k2 long, nodes array<long>, sketch binary")


def _fingerprint(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """128 bits for each set of hashes: two sums of differently mixed members."""
    out = []
    for salt in (0, 0x5851F42D4C957F2D):
        total = np.r_[np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)), dtype=np.uint64)]
        out.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
    return out


def _candidates(kinds: DataFrame, threshold: float, forest: Forest) -> DataFrame:
    """(a, b): links that join the texts of each subtree whose signatures agree as those of a pair at the threshold do."""
    floor, need = forest.floor(threshold), forest.agreeing(threshold)
    nodes = write_table(kinds.select("id", F.posexplode("nodes").alias("tree", "node")), "trie-nodes")
    shared = write_table(nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1"), "shared-nodes")
    parts = F.ceil(F.col("n") / forest.node).cast("int")
    met = nodes.join(shared, "node").withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    met = met.join(kinds.select("id", "sketch"), "id").select("node", "tree", "id", "sketch", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    keys = ["node", "i", "j"]
    work = met.select("node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "tree", "id", "sketch")
    work = work.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, keys):
            ids, tree = t.column("id").to_numpy(), t.column("tree").to_numpy()
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(t.num_rows, -1)
            out = []
            for lo, hi in zip(starts[:-1], starts[1:]):
                once = lo + np.unique(ids[lo:hi], return_index=True)[1]  # two parts of a subtree hold a text once each
                below = tree[lo] * forest.depth
                low = descend(sketch[once], range(below + floor, below + forest.depth), need)
                apart = np.flatnonzero(low != np.arange(len(low)))
                out.append((ids[once[apart]], ids[once[low[apart]]]))
            a, b = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return work.mapInArrow(run, "a long, b long").distinct()


def descend(sketch: np.ndarray, below: range, need: int, rows: int = 256) -> np.ndarray:
    """Per text of a subtree the first text of its group: groups are joined by pairs that agree in ``need`` values.

    The signatures are sorted by the values ``below`` the subtree's root. Nodes come from the longest
    shared prefix to the root; at a node the texts outside its largest group are compared with all of it.
    """
    n = len(sketch)
    low = np.arange(n)
    order = np.lexsort([sketch[:, c] for c in reversed(below)]) if len(below) else low
    differ = sketch[order][1:, below.start : below.stop] != sketch[order][:-1, below.start : below.stop]
    prefix = np.where(differ.any(1), differ.argmax(1), len(below)) if len(below) else np.zeros(n - 1, int)
    for level in np.unique(prefix)[::-1]:
        edge = np.flatnonzero(np.r_[True, prefix < level, True])
        for lo, hi in zip(edge[:-1], edge[1:]):
            if hi - lo < 2:
                continue
            node = order[lo:hi]
            groups, count = np.unique(low[node], return_counts=True)
            if len(groups) == 1:
                continue
            rest = node[low[node] != groups[count.argmax()]]
            for part in tiles(rest, rows):
                x, y = np.nonzero(_agreements(sketch[part], sketch[node]) >= need)
                low = _joined(low, part[x], node[y])
    return low


def _agreements(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(len(a), len(b)): in how many values the signatures agree."""
    if len(a) * len(b) <= 4096:
        return (a[:, None] == b[None]).sum(2)
    out = np.zeros((len(a), len(b)), np.uint16)
    columns = np.ascontiguousarray(b.T)
    for c in range(a.shape[1]):
        out += a[:, c, None] == columns[c]
    return out


def _joined(low: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The groups ``low`` (first member of each text's) after joining those of ``x`` and ``y``."""
    a, b = low[x], low[y]
    a, b = np.divmod(np.unique((np.maximum(a, b) * len(low) + np.minimum(a, b))[a != b]), len(low))
    if not len(a):
        return low
    to = np.arange(len(low))
    while True:
        new = to.copy()
        np.minimum.at(new, a, to[b])
        np.minimum.at(new, b, to[a])
        np.minimum.at(new, to[a], to[b])
        np.minimum.at(new, to[b], to[a])
        new = new[new]
        if (new == to).all():
            return to[low]
        to = new


def _verify(rows: DataFrame, groups: DataFrame, threshold: float, forest: Forest) -> DataFrame:
    blocks = groups.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / forest.block), F.ceil(F.sum("n") / forest.shingles)).cast("int").alias("blocks"))
    dealt = groups.join(blocks, "component").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    grouped = groups.select(F.col("rep").alias("doc_id"))
    few = sifted(rows, [F.col("doc_id")], grouped).filter("__may").drop("__may")  # not every text is shuffled
    sets = _sets(few.join(grouped, "doc_id", "left_semi"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rest = ["own", "id", "copies", "nodes", "shingles"]
    work = dealt.join(sets, ["rep", "k1", "k2"]).select("component", other.alias("other"), *rest).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *rest)
    keys = ["component", "i", "j"]
    work = work.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, keys):
            i, j, own, ids, copies = (t.column(c).to_numpy() for c in ("i", "j", "own", "id", "copies"))
            flat, at = numbers(t.column("shingles"), np.int64)
            flat = flat.view(np.uint64)
            paths = numbers(t.column("nodes"), np.int64)[0].reshape(t.num_rows, -1)
            out = []
            for lo, hi in zip(starts[:-1], starts[1:]):
                once = lo + np.sort(np.unique(ids[lo:hi], return_index=True)[1])  # an id may come twice
                if i[lo] == j[lo]:
                    parts = tiles(once, forest.tile)
                    pairs = itertools.combinations_with_replacement(parts, 2)
                else:
                    pairs = itertools.product(tiles(once[own[once] == i[lo]], forest.tile), tiles(once[own[once] == j[lo]], forest.tile))
                tally = Tally(ids[once])
                for a, b in pairs:
                    link = _linked(a, b, flat, at, paths, threshold)
                    if link.any():
                        tally.add(*_summary(a, b, link, ids, copies))
                if tally.edges:
                    out.append(tally.rows())
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "n", "low"])

    return work.mapInArrow(run, "id long, n long, low long")


def _sets(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, texts in text_chunks(batch.column(1)):
                hashes, first = shingle_sets(texts)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *map(pa.array, _fingerprint(hashes, first)), lists], names=["rep", "k1", "k2", "shingles"])

    return rows.select("doc_id", "text").mapInArrow(run, "rep long, k1 long, k2 long, shingles array<long>")


def _linked(a, b, flat, at, paths, threshold) -> np.ndarray:
    """(len(a), len(b)): pairs that meet in some tree and whose Jaccard similarity reaches the threshold."""
    meet = np.zeros((len(a), len(b)), bool)
    for tree in range(paths.shape[1]):
        meet |= paths[a, tree][:, None] == paths[b, tree][None, :]
    n = np.diff(at)
    meet &= np.minimum(n[a][:, None], n[b][None, :]) >= threshold * np.maximum(n[a][:, None], n[b][None, :]) - 1e-9
    if a is b:
        np.fill_diagonal(meet, False)
    link = np.zeros(meet.shape, bool)
    ra, rb = np.flatnonzero(meet.any(1)), np.flatnonzero(meet.any(0))
    if not len(ra):
        return link
    pairs = int(meet.sum())
    if pairs <= 4 * (len(ra) + len(rb)):
        for x, y in np.argwhere(np.triu(meet) if a is b else meet):
            p, q = flat[at[a[x]] : at[a[x] + 1]], flat[at[b[y]] : at[b[y] + 1]]
            common = _common(p, q)
            link[x, y] = common >= threshold * (len(p) + len(q) - common) - 1e-9
        return link | link.T if a is b else link
    common = _common_counts([flat[at[k] : at[k + 1]] for k in a[ra]], [flat[at[k] : at[k + 1]] for k in b[rb]])
    union = n[a[ra]][:, None] + n[b[rb]][None, :] - common
    link[np.ix_(ra, rb)] = common >= threshold * union - 1e-9
    return link & meet


def _common(p: np.ndarray, q: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    at = np.searchsorted(q, p)
    at[at == len(q)] = len(q) - 1
    return int((q[at] == p).sum())


def _common_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 1 << 14) -> np.ndarray:
    """Intersection sizes of all sets of ``left`` with all of ``right``: products of 0/1 matrices, some columns at a time."""
    values = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    kinds, col = np.unique(values, return_inverse=True)
    shared = (np.bincount(col[owner < len(left)], minlength=len(kinds)) > 0) & (np.bincount(col[owner >= len(left)], minlength=len(kinds)) > 0)
    number = np.cumsum(shared) - 1
    keep = shared[col]
    col, owner = number[col[keep]], owner[keep]
    order = np.argsort(col, kind="stable")
    col, owner = col[order], owner[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for lo in range(0, int(shared.sum()), width):
        s = slice(*np.searchsorted(col, [lo, lo + width]))
        m = np.zeros((len(left) + len(right), width), np.float32)
        m[owner[s], col[s] - lo] = 1
        out += np.rint(m[: len(left)] @ m[len(left) :].T).astype(np.int64)
    return out


def _summary(a, b, link, ids, copies) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if a is b:
        return ids[a], link @ copies[a], linked_minima(link, ids[a])
    both = np.zeros((len(a) + len(b),) * 2, bool)
    both[: len(a), len(a) :] = link
    both |= both.T
    every = np.concatenate([ids[a], ids[b]])
    return every, np.concatenate([link @ copies[b], link.T @ copies[a]]), linked_minima(both, every)
