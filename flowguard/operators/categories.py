"""Frequency index of categorical columns with any number of values.

The index is a table (column, value, count, index), never a list on the driver: values are counted in
one pass for all columns, ranked by a range partition with prefix sums, and joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.functions.exprs import qcol
from flowguard.session import drop_table, write_table

#: A column's most frequent values, so many and so long at most, reach the rows by a broadcast: 4 MB of text in UTF-8.
LOOKUP_RANKS, LOOKUP_CHARS = 4_096, 256
#: ``monotonically_increasing_id`` holds the partition above so many bits, and the row's number below.
ROW_BITS = 33


def category_text(df: DataFrame, name: str) -> Column:
    """The value as text; null for nulls and NaN."""
    c = qcol(name)
    if df.schema[name].dataType.typeName() in ("double", "float"):
        c = F.when(~F.isnan(c), c)
    return c.cast("string")


@dataclass
class CategoryIndex:
    """A fitted index: per column, values by count (largest first), then text, numbered from 0."""

    table: DataFrame          # (column, value, count, index), in the shared folder
    sizes: dict[str, int]     # values per column
    far: dict[str, int]       # those that are too rare or too long for the lookup
    scratch: list[DataFrame] = field(default_factory=list)

    def transform(self, df: DataFrame, suffix: str = "_idx") -> DataFrame:
        """Adds ``<column><suffix>``: the index, or the number of values for a null, a NaN or an unseen value.

        The most frequent values come from a broadcast lookup of bounded size, so none of them meets in
        a shuffle. Only if a column has further values, the rows that the lookup leaves open are joined on the
        value; each known one of these holds less than 1/4,096 of the fitted rows, or is very long, and AQE may split
        its partition. The rows are read twice then, so they should be a table. With several such columns
        the rows are written between them.
        """
        taken = [c + suffix for c in self.sizes if c + suffix in df.columns]
        if taken:
            raise ValueError(f"columns exist already: {', '.join(taken)}")
        value, joined = "__category_value", 0
        for c, n in self.sizes.items():
            out = c + suffix
            mine = self.table.filter(F.col("column") == c)
            lookup, others = (mine.filter(p).select(F.col("value").alias(value), F.col("index").alias(out)) for p in (near(), ~near()))
            if self.far[c] and joined:
                df = write_table(df, "category-rows")
                self.scratch.append(df)
            rows = df.withColumn(value, category_text(df, c)).join(F.broadcast(lookup), value, "left")
            if self.far[c]:
                joined += 1
                unknown = qcol(out).isNull() & F.col(value).isNotNull()
                rows = rows.filter(~unknown).unionByName(rows.filter(unknown).drop(out).join(others, value, "left"))
            df = rows.drop(value).withColumn(out, F.coalesce(qcol(out), F.lit(float(n))))
        return df

    def release(self) -> None:
        """Delete the index and what ``transform`` wrote, when nothing reads its results any more."""
        for t in (self.table, *self.scratch):
            drop_table(t)
        self.scratch = []


def near() -> Column:
    return (F.col("index") < LOOKUP_RANKS) & (F.char_length("value") <= LOOKUP_CHARS)


def fit_category_index(df: DataFrame, columns: Sequence[str]) -> CategoryIndex:
    """Index of the values of ``columns``; a repeated name counts once. Reads the rows once.

    Dense ranks without a global window: counts are range-partitioned and sorted, each row's place in its
    partition is written, and the partitions' sizes (a row per partition and column) give what lies before.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        raise ValueError("no columns to index")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), category_text(df, c).alias("value")) for c in columns])
    counts = df.select(F.inline(cells)).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    order = [F.col("column"), F.col("count").desc(), F.col("value")]
    placed = counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = write_table(placed, "category-places")
    part, place = F.shiftright("at", ROW_BITS), F.col("at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    blocks = placed.groupBy(part.alias("part"), "column").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("column").orderBy("part")) - F.col("n")
    blocks = blocks.select("part", "column", (before - F.col("first")).alias("shift"))
    ranked = placed.withColumn("part", part).join(F.broadcast(blocks), ["part", "column"])
    index = write_table(ranked.select("column", "value", "count", (place + F.col("shift")).cast("double").alias("index")), "category-index")
    drop_table(placed)
    found = {r["column"]: r for r in index.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.count_if(~near()).alias("far")).collect()}
    return CategoryIndex(index, *({c: found[c][k] if c in found else 0 for c in columns} for k in ("n", "far")))
