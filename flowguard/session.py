"""Session-level helpers: shared scratch folders and lineage cuts.

The caller owns the SparkSession. Nothing here sets memory or partition counts; AQE sizes
shuffles at run time. Scratch data goes below the cluster's shared ``spark.checkpoint.dir``
(never a machine-local temp folder); only a session on a local master may leave it unset.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "flowguard", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and local runs; on a cluster pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")  # local mode: the driver JVM runs the tasks
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def cluster_conf(executors: int = 1000, cores_per_executor: int = 8) -> dict[str, str]:
    """Suggested settings for a cluster reading very large captures (apply when building the session).

    The library itself sets none of these. Shuffle partitions start high and AQE coalesces
    them to ~256 MB; skewed partitions (one label or day with a third of the rows) are split
    at run time; file splits of 256 MB keep a task's input bounded; automatic broadcast stays
    at its default.
    """
    slots = executors * cores_per_executor
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(max(200, 3 * slots)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session; made only for a local master (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="flowguard-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


#: HotSpot never compiles a method of more bytes of code than this: it is interpreted for all rows.
COMPILED_BYTES = 8000
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_narrowed: dict[str, list] = {}  # by session: blocks inside, the caller's setting
_narrowing = threading.Lock()


@contextlib.contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Stages run inside the block have no method that the JVM leaves uncompiled; results are the same.

    Spark fuses an operator chain over some 40 columns to one method of more than ``COMPILED_BYTES``. With the limit
    set to that, such a chain runs operator by operator, whose projections are cut into small methods.
    The caller's setting comes back when the last block of its session ends; a lower one stays.
    """
    key = spark._jsparkSession.sessionUUID()
    with _narrowing:
        held = _narrowed.setdefault(key, [0, spark.conf.get(METHOD_LIMIT, None)])
        held[0] += 1
        if held[1] is None or int(held[1]) > COMPILED_BYTES:
            spark.conf.set(METHOD_LIMIT, str(COMPILED_BYTES))
    try:
        yield
    finally:
        with _narrowing:
            held[0] -= 1
            if not held[0]:
                del _narrowed[key]
                spark.conf.set(METHOD_LIMIT, held[1]) if held[1] is not None else spark.conf.unset(METHOD_LIMIT)


def made_once(df: DataFrame) -> DataFrame:
    """The same rows; filters on them stay above (as above any observed frame).

    Spark moves a filter below the projection that makes its columns, which are then made twice for each row.
    """
    return df.observe(Observation(), F.count(F.lit(1)).alias("rows"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/flowguard-scratch/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write a parquet table to the shared folder and read it back.

    One pass computes and writes the frame (``Dataset.checkpoint`` would compute it twice); a
    lost executor's tasks read the files again. Column metadata (ML attributes) is kept.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Cells of a partition of a frame that is cached for fits: its rows times (8 + their values, those of vectors included).
TASK_CELLS = 30_000_000
#: Fewer cells than this are not worth a task of their own.
MIN_TASK_CELLS = 500_000


def task_count(cells: int, slots: int) -> int:
    """Tasks of one size for ``cells`` on ``slots`` cores: all cores busy if there is enough for each, whole waves beyond.

    A frame is read hundreds of times by the rounds of boosted trees, each as long as its last wave.
    """
    parts = -(-cells // TASK_CELLS)
    if parts > slots:
        return -(-parts // slots) * slots
    return max(parts, min(slots, -(-cells // MIN_TASK_CELLS)))


def row_cells(df: DataFrame) -> int:
    """Cells of a row as ``TASK_CELLS`` counts them."""
    return 8 + sum(f.metadata.get("ml_attr", {}).get("num_attrs", 1) for f in df.schema.fields)


def dealt(df: DataFrame, rows: int, by: str | None = None) -> DataFrame:
    """``materialize`` for a projection of a table of the shared folder, of about ``rows`` rows: no second table is written.

    Lost blocks are made again from that table, which must stay as long as the frame is read. ``by``: a column of
    evenly spread numbers that deals the rows out and is dropped; without one Spark sorts every partition by its
    rows' hashes first, so that a task that is run again deals them the same way. ``unpersist`` releases it.
    """
    rest = df.drop(by) if by else df
    parts = max(task_count(rows * row_cells(rest), df.sparkSession.sparkContext.defaultParallelism), 1)
    out = df.repartition(parts, by).drop(by) if by else df.repartition(parts)
    return out.persist(StorageLevel.DISK_ONLY)


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """``write_table``, cached on disk: for frames that MLlib's fits read a few times each.

    What a fit iterates over it keeps in memory itself (blocks of a gradient, bagged rows of trees), many times as
    large as the frame: the memory is left to that.

    A file split holds as many rows as its format packs into some bytes, and what a fit keeps of a row
    can be a hundred times that: rows are dealt out anew where a task would get more than ``TASK_CELLS``, where
    cores would be left idle (``task_count``), and where the longest split or a part of a wave would keep them waiting.
    """
    out, width = write_table(df, name), row_cells(df)
    slots = out.sparkSession.sparkContext.defaultParallelism
    held = out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))  # no column is read
    rows, most = held.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    found, parts = out.rdd.getNumPartitions(), max(task_count(rows * width, slots), 1)
    longest, even = -(-found // slots) * most, -(-parts // slots) * -(-rows // parts)  # rows that a core reads, at worst
    if found < parts or longest > 1.1 * even:
        out = out.repartition(parts)
    return out.persist(StorageLevel.DISK_ONLY)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_table(df: DataFrame) -> None:
    """Unpersist and delete a table of ``write_table`` or ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    df.unpersist()
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
