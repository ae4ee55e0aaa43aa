"""Embedding near-duplicates by lattice hashing (operator 1).

Each of several tables projects a unit vector to eight dimensions, shifts it and decodes it to
the nearest point of the E8 lattice; the point is the vector's home cell. A vector also probes
the neighbouring points nearest to its projection. Two vectors are compared if one's home is the
other's home or probe in some table; only pairs whose cosine (double precision) reaches the
threshold are linked.

Equal vectors are one vector with a count. A cell's vectors are dealt to blocks, and blocks are
compared by matrix products; a task holds two blocks and returns a row per vector and block
(links counted, smallest linked id), never pairs. A pair that meets in several cells counts in
the first of them only, which a task can tell from the two vectors alone.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import Tally, components, linked_minima, mix, numbers, tiles, whole_groups, write_table


@dataclass(frozen=True)
class Lattice:
    """``tables`` tables of cells of size ``width`` (in units of a projected unit vector).

    At cosine 0.93 a table finds about 43 % of the pairs; twelve tables find 99.9 %. Unrelated
    vectors meet in about one cell in 7,000 per table.
    """

    tables: int = 12
    width: float = 0.8
    probes: int = 24
    seed: int = 1
    block: int = 4096  # vectors of a block: each goes to a task for each block of its cell
    tile: int = 512  # vectors of a tile: the blocks of a task are compared tile by tile


@lru_cache(1)
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: all (+-1, +-1, 0^6), and (+-1/2)^8 with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest integer point with an even sum."""
    near = np.rint(x)
    error = x - near
    odd = np.flatnonzero(near.sum(1) % 2)
    k = np.abs(error[odd]).argmax(1)
    near[odd, k] += np.where(error[odd, k] >= 0, 1.0, -1.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point: the better of the nearest even-sum integer point and its half-shifted twin."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


@lru_cache(16)
def _projections(lattice: Lattice, dim: int) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.default_rng([lattice.seed, dim])
    return [(rng.normal(size=(dim, 8)) / lattice.width, rng.uniform(0, 2, 8)) for _ in range(lattice.tables)]


def cells(unit: np.ndarray, lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """(home, probes) of unit vectors: hashes of shape (n, tables) and (n, tables, probes)."""
    n = len(unit)
    home = np.empty((n, lattice.tables), np.uint64)
    probe = np.empty((n, lattice.tables, lattice.probes), np.uint64)
    for t, (matrix, shift) in enumerate(_projections(lattice, unit.shape[1])):
        x = unit @ matrix + shift
        point = decode(x)
        # the neighbour point + v is nearer the larger the inner product of v and the remainder (all v have length sqrt 2)
        near = np.argsort((point - x) @ shortest().T, axis=1, kind="stable")[:, : lattice.probes]
        home[:, t] = _hash(point, t)
        probe[:, t] = _hash(point[:, None, :] + shortest()[near], t)
    return home, probe


def _hash(points: np.ndarray, t: int) -> np.ndarray:
    double = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    out = np.full(points.shape[:-1], t + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(8):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + double[..., i])
    return out


def near_duplicates(df: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    lattice: Lattice = Lattice()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Vectors are compared only if their labels are equal and not null and their lengths are equal.
    A vector that is null, empty, zero or holds null or non-finite components has no links and is
    its own component; so has a row without an id, which is kept. Rows that repeat an id and its
    vector count as one vector; ids are expected to be unique otherwise.
    """
    v = F.col("embedding")
    single = df.schema[embedding].dataType.simpleString() == "array<float>"  # floats are sent as they are, all else as doubles
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<float>" if single else "array<double>").alias("embedding"),
                     F.col(label).cast("string").alias("label")).distinct()
    fit = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
           & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    rows = write_table(rows.withColumn("fit", F.coalesce(fit, F.lit(False))).select(
        "vec_id", "embedding", "label", "fit", F.xxhash64("label", "embedding").alias("k1"), F.xxhash64("embedding", F.lit(1), "label").alias("k2")), "vectors")

    group = F.struct("k1", "k2")  # 128 bits stand for label and vector
    kinds = write_table(rows.filter("fit").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"),
                                                                   F.min_by("embedding", "vec_id").alias("embedding"), F.first("label").alias("label")), "vector-kinds")
    found = write_table(_compare(kinds, threshold, lattice), "vector-links")
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")), "vectors")
    by_kind = kinds.select("k1", "k2", "rep", "copies").join(links, F.col("rep") == links["id"], "left").drop("id") \
        .join(roots, F.col("rep") == roots["id"], "left").drop("id")
    own = by_kind.select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = rows.filter("fit").select("vec_id", "k1", "k2").join(own, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionAll(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _compare(kinds: DataFrame, threshold: float, lattice: Lattice) -> DataFrame:
    """(id, n, low): links of a vector found in one task, and the smallest id it is linked with there (directly or not)."""
    base = kinds.select("rep", "label", "embedding")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            salt = _label_salt(batch.column(1))
            for at, unit in _by_length(batch.column(2)):
                for lo in range(0, len(at), 1024):
                    sel = at[lo : lo + 1024]
                    home, probe = cells(unit[lo : lo + 1024], lattice)
                    both = np.concatenate([home[:, :, None], probe], 2).reshape(len(sel), -1) ^ salt[sel][:, None] ^ np.uint64(unit.shape[1])
                    at_home = np.zeros((lattice.tables, lattice.probes + 1), bool)
                    at_home[:, 0] = True
                    yield pa.RecordBatch.from_arrays([
                        pa.array(both.ravel().view(np.int64)), pa.array(np.repeat(ids[sel], both.shape[1])),
                        pa.array(np.tile(at_home.ravel(), len(sel)))], names=["cell", "id", "home"])

    keys = base.mapInArrow(keyed, "cell long, id long, home boolean")
    keys = write_table(keys, "vector-cells")
    counts = keys.groupBy("cell").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("long")).alias("h"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    counts = write_table(counts.filter("h > 0 and lo < hi").select(
        "cell", F.ceil(F.col("h") / lattice.block).cast("int").alias("hb"), F.ceil(F.col("n") / lattice.block).cast("int").alias("ab")), "vector-cell-counts")
    live = keys.join(counts, "cell")
    # a home row goes to block i of the homes against every block j of all rows, and a row of block j to every i
    h1, h2 = F.pmod(F.xxhash64("id"), F.col("hb")).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("ab")).cast("int")
    homes = live.filter("home").select("cell", "id", F.lit(True).alias("side"), h1.alias("i"), F.explode(F.sequence(F.lit(0), F.col("ab") - 1)).alias("j"))
    alls = live.select("cell", "id", F.lit(False).alias("side"), F.explode(F.sequence(F.lit(0), F.col("hb") - 1)).alias("i"), h2.alias("j"))
    work = homes.unionAll(alls).join(kinds.select(F.col("rep").alias("id"), "copies", "label", "embedding"), "id")
    work = work.select("cell", "i", "j", "side", "id", "copies", "label", "embedding").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(lattice)
        for t, starts in whole_groups(batches, ["cell", "i", "j"]):
            cell = t.column("cell").to_numpy().view(np.uint64)
            side = t.column("side").to_numpy(zero_copy_only=False)
            ids, copies = t.column("id").to_numpy(), t.column("copies").to_numpy()
            salt = _label_salt(t.column("label"))
            length, place, unit = np.zeros(t.num_rows, int), np.zeros(t.num_rows, int), {}
            for at, values in _by_length(t.column("embedding")):
                length[at], place[at] = values.shape[1], np.arange(len(at))
                unit[values.shape[1]] = values
            out: list[tuple] = []
            for lo, hi in zip(starts[:-1], starts[1:]):
                if hi - lo == 2 and ids[lo] == ids[lo + 1]:
                    continue  # a vector alone
                rows = np.arange(lo, hi)
                found = []
                for n in (length[lo],) if (length[lo:hi] == length[lo]).all() else np.unique(length[lo:hi]):
                    group = rows[length[lo:hi] == n]
                    a, b = group[side[group]], group[~side[group]]
                    for p in tiles(a, lattice.tile):
                        for q in tiles(b, lattice.tile):
                            x = _tile(cell[lo], ids[p], ids[q], copies[p], copies[q], salt[p], salt[q], unit[n][place[p]], unit[n][place[q]], threshold, known)
                            if x:
                                found.append(x)
                if found:
                    tally = Tally(np.concatenate([x[0] for x in found]))
                    for x in found:
                        tally.add(*x)
                    out.append(tally.rows())
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "n", "low"])

    return work.mapInArrow(compared, "id long, n long, low long")


class Known:
    """Cells of the vectors that a task has met last: a vector near others comes in many cells."""

    SIZE = 20_000

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def cells(self, ids: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = [k for k, i in enumerate(ids.tolist()) if i not in self.rows]
        if new:
            if len(self.rows) + len(new) > self.SIZE:
                self.rows.clear()
                new = list(range(len(ids)))
            home, probe = cells(unit[new], self.lattice)
            self.rows.update(zip(ids[new].tolist(), zip(home, probe)))
        found = [self.rows[i] for i in ids.tolist()]
        return np.stack([f[0] for f in found]), np.stack([f[1] for f in found])


def _tile(cell, ida, idb, copies_a, copies_b, salt_a, salt_b, x, y, threshold, known: Known) -> tuple | None:
    """Links between home rows a and rows b of one cell, for a ``Tally``: those that count in this cell, and the components of all."""
    link = (x @ y.T >= threshold) & (salt_a[:, None] == salt_b[None, :]) & (ida[:, None] != idb[None, :])
    ra, rb = np.flatnonzero(link.any(1)), np.flatnonzero(link.any(0))
    if not len(ra):
        return None
    ida, idb, link = ida[ra], idb[rb], link[np.ix_(ra, rb)]
    mask = salt_a[ra[0]] ^ np.uint64(x.shape[1])
    a, b = known.cells(ida, x[ra]), known.cells(idb, y[rb])
    counted = link & ~_met_before(cell ^ mask, ida, idb, a, b)
    # a row of b that isn't at home here gets its count from this side too; one at home has the pair as a row of a as well
    away = ~(b[0] == cell ^ mask).any(1)
    both = np.zeros((len(ida) + len(idb),) * 2, bool)
    both[: len(ida), len(ida) :] = link
    both |= both.T
    every = np.concatenate([ida, idb])
    n = np.concatenate([counted @ copies_b[rb], np.where(away, counted.T @ copies_a[ra], 0)])
    return every, n, linked_minima(both, every)


def _met_before(cell, ida, idb, a, b) -> np.ndarray:
    """Pairs that an earlier cell counts: one of an earlier table, or of this table the smaller id's home."""
    (ha, probes_a), (hb, probes_b) = a, b
    at = np.flatnonzero((ha == cell).any(0))
    t = int(at[0]) if len(at) else 0  # none: a last bit differs from the first pass, and the pair counts here
    seen = np.zeros((len(ida), len(idb)), bool)
    for k in range(t):
        seen |= _meets(ha[:, k], hb[:, k], probes_b[:, k]) | _meets(hb[:, k], ha[:, k], probes_a[:, k]).T
    # in this table: at the home of the smaller id if the other row comes there, else at the home of the larger
    elsewhere = _meets(hb[:, t], ha[:, t], probes_a[:, t]).T  # the row of a comes to b's home
    return seen | ((idb[None, :] < ida[:, None]) & (hb[:, t] != cell)[None, :] & elsewhere)


def _meets(home: np.ndarray, other_home: np.ndarray, other_probes: np.ndarray) -> np.ndarray:
    """(i, j): home i is the home or a probe of j."""
    cells_, which = np.unique(home, return_inverse=True)
    return ((other_home[None, :] == cells_[:, None]) | (other_probes[None, :, :] == cells_[:, None, None]).any(2))[which]


def _label_salt(labels) -> np.ndarray:
    labels = labels.combine_chunks() if isinstance(labels, pa.ChunkedArray) else labels
    coded = labels.dictionary_encode()
    own = np.array([_text_hash(s) for s in coded.dictionary.to_pylist()], np.uint64)
    return own[coded.indices.to_numpy()]


def _text_hash(s: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little")


def _by_length(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors in double precision) for each length of vector."""
    flat, offsets = numbers(column, np.float64)
    length = np.diff(offsets)
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        x = flat[offsets[at][:, None] + np.arange(n)]
        x = x / np.abs(x).max(1, keepdims=True)  # squares of very large and very small components stay in range
        yield at, x / np.sqrt((x * x).sum(1, keepdims=True))
