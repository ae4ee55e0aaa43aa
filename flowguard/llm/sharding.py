"""Sharding by sampled splitters (operator 9): native DataFrame operations only.

Records are ordered by a key (hash of the text, hash of the id). Size-weighted key samples give
splitters that cut the order into many small ranges; ranges that turn out overfull are cut again
from samples of their own. The exact bytes and rows of each range then place every record in the
order, and shard boundaries are the byte quantiles. Law ``bytes``: shard sizes near equal.

A group of equal texts is contiguous in the order. A boundary that falls into a small group moves
to the group's nearer end, so such a group stays in one shard; a larger group (a hot text) is
divided by id, in the ranges as in the shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import drop_table, write_table

#: Rows that a range holds at about (a range is sorted in one task).
RANGE_ROWS = 100_000
SAMPLES_PER_RANGE = 32
#: A group of equal texts up to this share of a shard's bytes isn't divided by a shard boundary.
WHOLE_GROUP = 0.01
HEADER_BYTES = 8


def assign_shards(df: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
                  range_rows: int = RANGE_ROWS, samples: int = SAMPLES_PER_RANGE, seed: int = 9) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row, and the ``keep`` columns.

    A null text has no bytes and the checksum of the empty text. Repeated rows each get a slot.
    A null id is an id like any other. An empty table gives an empty result. ``keep`` columns
    named like a result column are left out.
    """
    spark = df.sparkSession
    own = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "__key", "__range", "__at")
    content = F.coalesce(F.col(text), F.lit(""))
    rows = write_table(df.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(content) + HEADER_BYTES).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.concat(_hex(F.xxhash64(content)), _hex(F.xxhash64(F.col(doc_id)))).alias("__key"),
        *[F.col(c) for c in keep if c not in own],
    ), "shard-keys")
    count, total = rows.agg(F.count("*"), F.sum("size")).first()
    if not count:
        return _result(rows, F.lit(0), F.lit(0).cast("long"), keep, own)

    quota = total / (shards * max(4, math.ceil(count / shards / range_rows)))
    splitters, sums = _ranges(rows, quota, total, samples, seed)
    before, at = [], [0, 0]
    for r in range(len(splitters) + 1):
        before.append(tuple(at))
        at = [a + b for a, b in zip(at, sums.get(r, (0, 0))[:2])]
    in_range = Window.partitionBy("__range").orderBy("__key", "doc_id")
    placed = rows.withColumn("__range", _below(splitters)).select(
        "*",
        (_pick([b[0] for b in before], F.col("__range")) + F.row_number().over(in_range) - 1).alias("__at"),
        (_pick([b[1] for b in before], F.col("__range"))
         + F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("__start"))
    placed = write_table(placed, "shard-order")
    drop_table(rows)

    cuts = _cuts(placed, shards, total)
    sharded = placed.withColumn("shard", _below(cuts))
    first = {r["shard"]: r["m"] for r in sharded.groupBy("shard").agg(F.min("__at").alias("m")).collect()}  # one row per shard
    return _result(sharded, F.col("shard"), F.col("__at") - _pick([first.get(s, 0) for s in range(shards)], F.col("shard")), keep, own)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the rows of ``assign_shards(..., keep=...)``: a folder per shard, files in slot ranges of about equal rows."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def _result(rows: DataFrame, shard: Column, slot: Column, keep, own) -> DataFrame:
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), shard.cast("int").alias("shard"),
                       slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *[c for c in keep if c not in own])


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 16, "0")


def _ranges(rows: DataFrame, quota: float, total: int, samples: int, seed: int) -> tuple[list[str], dict]:
    """Splitters for ranges of about ``quota`` bytes, and the exact (rows, bytes) of each range that has any."""
    splitters: list[str] = []
    heavy = {0: total}
    round_ = 0
    while True:
        found = set(splitters)
        each = quota / samples  # one sample stands for so many bytes, a larger record for its own
        u = F.pmod(F.xxhash64(F.lit(seed + round_), "__key", "doc_id"), F.lit(1 << 40)) / float(1 << 40)
        drawn = rows.withColumn("__range", _below(splitters)) if splitters else rows.withColumn("__range", F.lit(0))
        drawn = drawn.filter(F.col("__range").isin(list(heavy)) & (u < F.col("size") / each)).groupBy("__range", "__key").agg(
            F.sum(F.greatest(F.col("size").cast("double"), F.lit(each))).alias("w")).collect()  # total / each rows at about
        by_range: dict[int, list] = {}
        for r in drawn:
            by_range.setdefault(r["__range"], []).append((r["__key"], r["w"]))
        for r, keys in by_range.items():
            keys.sort()
            whole = sum(w for _, w in keys)
            parts = max(2, round(heavy[r] / quota)) if len(keys) > 1 else 1
            done, cut = 0.0, 1
            for key, w in keys:
                if cut < parts and done >= whole * cut / parts:
                    found.add(key)
                    cut = math.floor(done * parts / whole) + 1
                done += w
        grew = len(found) > len(splitters)
        splitters = sorted(found)
        sums = {r["__range"]: (r["n"], r["b"], r["lo"] < r["hi"]) for r in rows.withColumn("__range", _below(splitters)).groupBy("__range").agg(
            F.count("*").alias("n"), F.sum("size").alias("b"), F.min("__key").alias("lo"), F.max("__key").alias("hi")).collect()}  # one row per range
        heavy = {r: b for r, (_, b, divisible) in sums.items() if b > 2 * quota and divisible}
        round_ += 1
        if not heavy or not grew and round_ > 3:
            return splitters, sums


def _below(splitters: list[str]) -> Column:
    """How many of the sorted splitters are <= the key: looked up in two steps of about sqrt(n) comparisons."""
    if not splitters:
        return F.lit(0)
    step = max(1, math.isqrt(len(splitters)))
    whole = F.split(F.lit(",".join(splitters)), ",")
    coarse = F.split(F.lit(",".join(splitters[::step])), ",")
    key = F.col("__key")
    block = F.size(F.filter(coarse, lambda s: s <= key))
    return F.when(block == 0, 0).otherwise(
        (block - 1) * step + F.size(F.filter(F.slice(whole, (block - 1) * step + 1, F.lit(step)), lambda s: s <= key)))


def _pick(values: list[int], index: Column) -> Column:
    return F.element_at(F.split(F.lit(",".join(map(str, values))), ","), index.cast("int") + 1).cast("long")


def _cuts(placed: DataFrame, shards: int, total: int) -> list[str]:
    """The first key of each shard but the first: byte quantiles, moved off small groups of equal texts."""
    share = total / shards
    wanted = F.least(F.floor((F.col("__start") + F.col("size") / 2) / share), F.lit(shards - 1)).cast("int")
    first = {r["s"]: r["k"] for r in placed.groupBy(wanted.alias("s")).agg(F.min("__key").alias("k")).collect()}  # one row per shard
    group = F.substring("__key", 1, 16)
    keys = [first[s] for s in sorted(first) if s > 0]
    if not keys:
        return []
    spans = {r["g"]: (r["a"], r["b"]) for r in placed.filter(group.isin(sorted({k[:16] for k in keys}))).groupBy(group.alias("g")).agg(
        F.min("__start").alias("a"), F.max(F.col("__start") + F.col("size")).alias("b")).collect()}  # one row per boundary
    cuts = []
    for s in sorted(first):
        if s > 0:
            key = first[s]
            lo, hi = spans[key[:16]]
            if hi - lo <= WHOLE_GROUP * share:
                key = key[:16] if s * share - lo <= hi - s * share else key[:16] + "~"  # before or after all of the group
            cuts.append(key)
    return sorted(cuts)
