"""Train/test splitting and sampling. No split depends on how rows are dealt to partitions.

``split_by_source`` and ``split_by_hash`` are plain filters (no shuffle, no sort). The random split
and the sample draw by a row's content and its number among equal rows, which a count of each
content gives without a sort: equal rows are combined before the shuffle, however many there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.functions.exprs import qcol
from flowguard.session import write_table

HASH_BUCKETS = 10_000
DRAW = "__draw"
DRAWS = 1 << 32
#: Equal rows that one task makes anew; more are dealt to several.
EQUAL_ROWS = 100_000


def split_by_source(
    df: DataFrame, train_sources: Sequence[str], test_sources: Sequence[str], source_col: str = "source_file"
) -> tuple[DataFrame, DataFrame]:
    """Rows from the train list / the test list; rows from neither vanish; the tag is dropped."""
    src = qcol(source_col)
    train = df.filter(src.isin(list(train_sources))).drop(source_col)
    test = df.filter(src.isin(list(test_sources))).drop(source_col)
    return train, test


def split_random(
    df: DataFrame, train_fraction: float = 0.8, seed: int = 42, source_col: str = "source_file"
) -> tuple[DataFrame, DataFrame]:
    """Train and test by a seeded draw per row (``with_draw``), written once; both parts are filters on the draw.

    The same rows give the same parts in any layout, also if an executor is lost or the input is
    read again. ``drop_table`` of either part's files deletes what was written.
    """
    tagged = write_table(with_draw(df, seed).drop(source_col), "random-split")
    low = F.col(DRAW) < int(train_fraction * DRAWS)
    return tagged.filter(low).drop(DRAW), tagged.filter(~low).drop(DRAW)


def _drawn(text: Column) -> Column:
    """A number in [0, 2^32): the first 32 bits of md5; the same in SQL engines."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def with_draw(df: DataFrame, seed: int = 42, of: Sequence[str] | None = None) -> DataFrame:
    """``df`` with a draw in [0, 2^32) per row that follows from its values and its number among equal rows.

    The draw is the head of md5("<values joined by |>|<number>:<seed>"), a null value being \\N and
    equal rows numbered from 0; ``of`` names the values that count (default: all). Rows are counted by content; a content's rows are then made anew,
    more than ``EQUAL_ROWS`` of them by several tasks. -0.0 becomes 0.0, as in any grouping.
    """
    columns = list(df.columns)
    # a row is grouped as one struct: with wide rows the optimiser would derive constraints from every column's expression
    counts = df.groupBy(F.struct(*[qcol(c) for c in columns]).alias("__row")).agg(F.count(F.lit(1)).alias("__n"))
    few = counts.filter(F.col("__n") <= EQUAL_ROWS).withColumn("__from", F.lit(0).cast("long"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(EQUAL_ROWS).cast("long"))
    several = counts.filter(F.col("__n") > EQUAL_ROWS).withColumn("__from", F.explode(starts)).repartition(F.xxhash64("__row"), "__from")
    each = few.unionByName(several).withColumn("__k", F.explode(F.sequence("__from", F.least(F.col("__n"), F.col("__from") + EQUAL_ROWS) - 1)))
    row = F.col("__row")
    text = F.concat_ws("|", *[F.coalesce(row.getField(c).cast("string"), F.lit("\\N")) for c in of or columns], F.col("__k").cast("string"))
    return each.select(*[row.getField(c).alias(c) for c in columns], _drawn(F.concat(text, F.lit(f":{seed}"))).alias(DRAW))


def hash_bucket(key: Column, seed: int = 42) -> Column:
    """Bucket in [0, 10000) from the first 32 bits of md5("<key>:<seed>"); the same in SQL engines."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % HASH_BUCKETS


def split_by_hash(
    df: DataFrame, key_cols: Sequence[str], train_fraction: float = 0.8, seed: int = 42,
    source_col: str = "source_file",
) -> tuple[DataFrame, DataFrame]:
    """Reproducible split: a row is in train when its key's bucket is below the bar, else in test.

    Rows with a null key share a bucket (that of the empty key). Deterministic across runs, layouts and executor loss, and pushes down as a filter.
    """
    parts = [F.coalesce(qcol(k).cast("string"), F.lit("")) for k in key_cols]  # a null key is a key like any other
    key = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    bar = int(round(train_fraction * HASH_BUCKETS))
    bucket = hash_bucket(key, seed)
    if source_col in df.columns:
        df = df.drop(source_col)
    return df.filter(bucket < bar), df.filter(bucket >= bar)


def sample_fraction(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Sample without replacement, the same in any layout; a no-op at fraction >= 1.

    A frame that has draws (column ``DRAW``) gets new ones from those and the seed; another gets ``with_draw``'s.
    """
    if fraction >= 1.0:
        return df
    if DRAW in df.columns:
        return df.filter(_drawn(F.concat(F.col(DRAW).cast("string"), F.lit(f":{seed}"))) < int(fraction * DRAWS))
    return with_draw(df, seed).filter(F.col(DRAW) < int(fraction * DRAWS)).drop(DRAW)


def sample_splits(
    train: DataFrame, test: DataFrame, fraction: float, seed: int = 42, test_fraction: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """Sampling after the split: train with ``seed``, test (whole unless asked otherwise) with ``seed + 1``."""
    return sample_fraction(train, fraction, seed), sample_fraction(test, test_fraction, seed + 1)


def split_dispatch(
    df: DataFrame,
    split: str,
    train_sources: Sequence[str] = (),
    test_sources: Sequence[str] = (),
    train_fraction: float = 0.8,
    seed: int = 42,
    key_cols: Sequence[str] = (),
    source_col: str = "source_file",
) -> tuple[DataFrame, DataFrame]:
    """``file`` -> by source lists; ``hash`` -> by keys; ``random``. What a split needs and lacks is an error."""
    if split == "file":
        if not train_sources or not test_sources or source_col not in df.columns:
            raise ValueError(f"the file split needs train and test sources and a {source_col!r} column")
        return split_by_source(df, train_sources, test_sources, source_col)
    if split == "hash":
        if not key_cols:
            raise ValueError("the hash split needs key columns")
        return split_by_hash(df, key_cols, train_fraction, seed, source_col)
    if split != "random":
        raise ValueError(f"no such split: {split!r}")
    return split_random(df, train_fraction, seed, source_col)


def tag_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """One frame with a ``split`` column, for reporting."""
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
