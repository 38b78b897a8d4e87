"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job wants; all of them can be set on a live session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even where that costs one more exchange later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cpus: str | int = 8, app: str = "ledgerline") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        # Call-site capture costs a round trip to the JVM for each column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Spark takes the size of compressed files for that of their rows in memory when it chooses what to broadcast, and builds
# the table of a broadcast join in the driver, where rows of keys and numbers take 25 to 150 times as much. A factor that
# covered all of it would have large tables shuffled for every lookup of small ones. A session's own setting is kept.
FACTOR, FILE_FACTOR = "spark.sql.sources.fileCompressionFactor", "3.0"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else made."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark.conf.get(FACTOR, None) is None:
        spark.conf.set(FACTOR, FILE_FACTOR)
    return spark


# File bytes behind one shuffle partition: a row takes some twenty times as much memory in a sort as in its file.
FILE_BYTES_PER_PARTITION = 4 << 20
MOST_PARTITIONS = 4096
# File bytes behind one slice. Each slice reads the whole table, so there are few.
FILE_BYTES_PER_SLICE = 192 << 20
MOST_SLICES = 8
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# What a task reads of files and what small partitions are merged to, unless the session has settings of its own. Both
# are many times as much in a sort, which so stays in memory.
TASK_SIZES = {"spark.sql.files.maxPartitionBytes": "16MB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB"}

# Written tables are read back by the library itself; this codec makes them a third smaller than Spark's own choice.
CODEC = "zstd"


def file_bytes(df: DataFrame) -> int:
    """The size of the files a frame reads. Rows that are not in files count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    files = sum(size for size in sizes if size < 1 << 60)  # more is Spark's word for unknown
    return int(files / float(df.sparkSession.conf.get(FACTOR, None) or 1))


def slices(df: DataFrame) -> int:
    """Into how many slices of its keys a table is best cut where a step would shuffle all of its rows at once."""
    return max(1, min(MOST_SLICES, file_bytes(df) // FILE_BYTES_PER_SLICE))


def sized(df: DataFrame) -> DataFrame:
    """The same frame, once shuffles start with as many partitions as its files call for.

    Partitions then keep their size when the tables grow; adaptive execution merges those that turn out small. The
    number only ever rises. Rows that are not in files call for nothing.
    """
    spark = df.sparkSession
    for key, size in TASK_SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, size)
    wanted = min(MOST_PARTITIONS, file_bytes(df) // FILE_BYTES_PER_PARTITION)
    if wanted > int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL, str(wanted))
    return df


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What is written or collected in here leaves no shuffle files behind.

    Otherwise they stay until the driver collects its garbage, so that the steps of a job add up on disk. For plans that
    run once: frames made in here and run again later have their shuffles worked out anew.
    """
    had = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if had is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, had)


# The temporary folders of local sessions, by application; the setting itself can't be changed on a live session.
_local: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Where it is unset, a local session, in which driver and executors are one process, has a temporary folder; a cluster
    has none, and what needs one fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if not os.path.isdir(_local.get(application, "")):
        _local[application] = tempfile.mkdtemp(prefix="ledgerline-")
    return _local[application]


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written tables and stream checkpoints, below :func:`shared_root`."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
