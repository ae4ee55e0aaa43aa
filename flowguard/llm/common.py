"""Shared helpers of the training-data operators: written tables, word hashes, groups, components."""

from __future__ import annotations

import gc
import io
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowguard.session import scratch_path

SHINGLE_WORDS = 5
CHUNK_CHARS = 1 << 19  # bytes of text that one vectorised pass works on; a longer text is a chunk of its own
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet below the shared checkpoint folder and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table of ``write_table`` that no later frame reads."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per application), as --py-files would."""
    sc = spark.sparkContext
    if getattr(sc, "_flowguard_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "code") + "/flowguard_code.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(path.toString())
    sc._flowguard_shipped = True


def with_columns(frame: DataFrame, keep: list[str], new: dict[str, str]) -> StructType:
    """The schema of ``keep`` columns of ``frame`` and then ``new`` ones (name: type)."""
    more = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in new.items()))
    return StructType([*frame.select(*[F.col(f"`{k}`") for k in keep]).schema.fields, *more.fields])


def beside_text(docs: DataFrame, keep: list[str], text: str) -> tuple[DataFrame, int]:
    """The ``keep`` columns and the text that a task reads, and that column's number: a text that is kept isn't sent twice."""
    if text in keep:
        return docs.select(*keep), keep.index(text)
    return docs.select(*keep, F.col(text).alias("__text")), len(keep)


def release(spark: SparkSession) -> None:
    """Let the driver's JVM collect its garbage, so that Spark deletes the shuffle files of finished steps."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def file_bytes(spark: SparkSession, path: str, limit: int) -> bytes:
    """The content of a file of at most ``limit`` bytes, of the driver or of any file system that Spark reads."""
    try:
        with open(path, "rb") as f:
            data = f.read(limit + 1)
    except FileNotFoundError:
        row = spark.read.format("binaryFile").load(path).filter(F.col("length") <= limit).first()
        data = bytes(row["content"]) if row else b"." * (limit + 1)
    if len(data) > limit:
        raise ValueError(f"{path} is larger than {limit} bytes")
    return data


def held_out(doc_id) -> F.Column:
    """The contract's fold: crc32 of the id's decimal text, modulo 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def chunks(sizes: Iterable[int], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose sizes add up to ``limit`` at most (a larger row is alone)."""
    lo = total = i = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n + 1
    if total:
        yield lo, i + 1


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], text: int, limit: int = 4 * CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in column number ``text`` (a larger row is alone)."""
    for batch in batches:
        for lo, hi in chunks(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist(), limit):
            yield batch.slice(lo, hi - lo)


def text_chunks(column: pa.Array, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, end, texts) of consecutive rows of at most ``limit`` bytes together (a larger row is alone)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for lo, hi in chunks(sizes, limit):
        yield lo, hi, texts_of(column.slice(lo, hi - lo))


# ---------------------------------------------------------------------------------------------
# Few rows among many

SIFT_BITS = 27  # the largest bitmap: 2**27 bits, 16 MB
_PIECE_BITS = 15  # bits of a row of the bitmap, those of bitmap_construct_agg


def sifted(rows: DataFrame, keys: list[Column], wanted: DataFrame, bits: int = SIFT_BITS) -> DataFrame:
    """``rows`` with ``__may``: false only where ``keys`` equal no row of ``wanted``, whose columns are compared in order.

    For a join with few rows: those of ``rows`` that can't match needn't be shuffled with all they
    carry. ``wanted`` travels as a bitmap of 16 bits a row, 2**``bits`` at most; one row in 16 (more if the
    bitmap is at its limit) passes by chance, so an exact join follows. The types of both must agree.
    """
    size = min(max((16 * wanted.count() - 1).bit_length(), _PIECE_BITS), bits)

    def place(columns: list[Column]) -> tuple[Column, Column]:
        at = F.shiftrightunsigned(F.xxhash64(*columns), 64 - size)
        return F.shiftright(at, _PIECE_BITS), at.bitwiseAND((1 << _PIECE_BITS) - 1)

    piece, bit = place([F.col(c) for c in wanted.columns])
    bitmap = wanted.groupBy(piece.alias("__piece")).agg(F.bitmap_construct_agg(bit).alias("__bits"))
    piece, bit = place(keys)
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, bit.bitwiseAND(7).cast("int")) == 1, F.lit(False))
    return rows.join(F.broadcast(bitmap), piece == F.col("__piece"), "left").withColumn("__may", held).drop("__piece", "__bits")


# ---------------------------------------------------------------------------------------------
# Hashes of words and shingles

_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.r_[np.ones(1, np.uint64), np.full(size, _BASE, np.uint64)], dtype=np.uint64)
            _INVERSES = np.cumprod(np.r_[np.ones(1, np.uint64), np.full(size, _INVERSE, np.uint64)], dtype=np.uint64)
    return _POWERS[:n], _INVERSES[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NOT_ALNUM = np.ones(256, bool)
_NOT_ALNUM[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(0x80, 0x100)]] = False


class Words:
    """Hashes of the words of several texts.

    ``hashes``: one 64-bit hash per word, in order; ``first[d]:first[d + 1]`` are the words of
    text d; ``start`` and ``end`` are byte positions in ``data`` (the UTF-8 of all texts, joined
    by a space). Words are runs of bytes outside ``separators``.
    """

    def __init__(self, texts: list[str], separators: np.ndarray = _SPACE):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b" ".join([*raw, b""])
        buf = np.frombuffer(self.data, np.uint8)
        gap = separators[buf]
        edge = np.flatnonzero(np.diff(np.r_[True, gap, True]))  # starts and ends alternate
        self.start, self.end = edge[::2], edge[1::2]
        at = np.cumsum([0, *(len(r) + 1 for r in raw)])
        self.first = np.searchsorted(self.start, at)
        power, inverse = _powers(len(buf) + 1)
        with np.errstate(over="ignore"):
            self._total = np.r_[np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], dtype=np.uint64)]
        self._inverse = inverse
        self.hashes = self._hash(self.end)

    def _hash(self, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self._total[end] - self._total[self.start]) * self._inverse[self.start])

    def prefixes(self, k: int) -> np.ndarray:
        """Hashes of the first ``k`` bytes of each word; the word's own hash if it isn't longer."""
        return self._hash(np.minimum(self.end, self.start + k))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(texts: list[str]) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged."""
    return Words(texts)


def plain_words(texts: list[str]) -> Words:
    """Lower-case words of letters and digits; everything else separates."""
    return Words([t.lower() for t in texts], _NOT_ALNUM)


def _fold(hashes: np.ndarray, k: int) -> np.ndarray:
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + n]
        return mix(out)


def shingles(w: Words, k: int = SHINGLE_WORDS, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the k-word shingles of each text in order, ``first`` as in ``Words``.

    With ``short`` a text of one to k - 1 words has one shingle of all its words.
    """
    counts = w.counts()
    n = np.maximum(counts - k + 1, 0)
    first = np.r_[0, np.cumsum(n)]
    pos = np.repeat(w.first[:-1] - first[:-1], n) + np.arange(first[-1])
    out = _fold(w.hashes, k)[pos] if first[-1] else np.zeros(0, np.uint64)
    few = np.flatnonzero((counts > 0) & (counts < k)) if short else ()
    if len(few):
        own = np.array([_fold(w.hashes[w.first[d] : w.first[d + 1]], counts[d])[0] for d in few], np.uint64)
        out = np.insert(out, first[few], own)
        n[few] = 1
        first = np.r_[0, np.cumsum(n)]
    return out, first


def least(values: np.ndarray, first: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """MinHash: per group of ``values`` and seed the smallest permuted value (rows of empty groups are the maximum)."""
    n = np.diff(first)
    out = np.full((len(n), len(seeds)), np.iinfo(np.uint64).max, np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        for i, (flip, odd) in enumerate(seeds):
            with np.errstate(over="ignore"):
                out[some, i] = np.minimum.reduceat((values ^ flip) * odd, first[some])
    return out


def permutations(count: int, seed: int) -> np.ndarray:
    out = np.random.default_rng(seed).integers(0, 1 << 64, (count, 2), np.uint64)
    out[:, 1] |= np.uint64(1)
    return out


# ---------------------------------------------------------------------------------------------
# Groups in sorted partitions

def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by ``keys`` (integers): tables of whole groups, with their start rows and the end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if len(held) > 1 and all(held[0].column(k)[0] == batch.column(k)[batch.num_rows - 1] for k in keys):
            continue  # still the same group
        t = pa.Table.from_batches(held).combine_chunks()
        starts = _starts(t, keys)
        if starts[-1]:
            yield t.slice(0, starts[-1]), starts
        held = t.slice(starts[-1]).to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, np.r_[_starts(t, keys), t.num_rows]


def _starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for k in keys:
        v = t.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def numbers(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, offsets) of a list column without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def linked_minima(link: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per vertex the smallest id of its component in the symmetric boolean matrix ``link``."""
    top = np.iinfo(np.int64).max
    low = ids.copy()
    while True:
        new = np.concatenate([np.minimum(low[k : k + 256], np.where(link[k : k + 256], low[None, :], top).min(1)) for k in range(0, len(ids), 256)])
        if (new == low).all():
            return low
        low = new


class Tally:
    """Links per id and components over the tiles of a group: what a task returns of it, a row per linked id."""

    def __init__(self, ids: np.ndarray):
        self.ids = np.unique(ids)
        self.n = np.zeros(len(self.ids), np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, ids: np.ndarray, n: np.ndarray, low: np.ndarray) -> None:
        """``n`` more links of ``ids``, each linked (directly or not) with ``low``."""
        at = np.searchsorted(self.ids, ids)
        np.add.at(self.n, at, n)
        to = np.searchsorted(self.ids, low)
        self.edges.append((at[at != to], to[at != to]))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, links, smallest id of the component within the group) of the linked ids."""
        a, b = (np.concatenate([e[k] for e in self.edges]) if self.edges else np.zeros(0, np.int64) for k in (0, 1))
        low = np.arange(len(self.ids))
        while True:
            new = low.copy()
            np.minimum.at(new, a, low[b])
            np.minimum.at(new, b, low[a])
            new = new[new]
            if (new == low).all():
                break
            low = new
        some = np.flatnonzero((self.n > 0) | (low != np.arange(len(low))))
        return self.ids[some], self.n[some], self.ids[low[some]]


def tiles(rows: np.ndarray, size: int) -> list[np.ndarray]:
    return [rows[k : k + size] for k in range(0, len(rows), size)]


# ---------------------------------------------------------------------------------------------
# Connected components

def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a, b: long): the smallest id of its component.

    Alternates two steps that replace a vertex's links by links to its smallest neighbour until
    the links are stars. Each step aggregates a minimum per vertex (combined before the shuffle),
    writes it, and joins it back: a join of two plain tables, whose large partitions Spark can
    split, so that a hub costs no single task. Every step's links are a written table.
    """
    now = write_table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-links")
    while not _stars(now):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = write_table(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}-low")
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            low.filter("m < a").select("a", F.col("m").alias("b"))).distinct()
        large = write_table(large, f"{name}-large")
        drop_table(low)
        drop_table(now)
        low = write_table(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-low")
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            low.select("a", F.col("m").alias("b"))).distinct()
        now = write_table(small, f"{name}-small")
        drop_table(low)
        drop_table(large)
    roots = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)


def _stars(links: DataFrame) -> bool:
    """Every vertex is either the end of links (a star's centre) or the start of exactly one."""
    roles = links.select(F.col("a").alias("v"), F.lit(1).alias("out")).unionAll(links.select(F.col("b").alias("v"), F.lit(0).alias("out")))
    per = roles.groupBy("v").agg(F.sum("out").alias("starts"), (F.count("*") - F.sum("out")).alias("ends"))
    return per.filter("starts > 1 OR (starts > 0 AND ends > 0)").isEmpty()
