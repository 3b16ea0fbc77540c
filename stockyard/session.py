"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. `forceOptimizeSkewedJoin` lets adaptive execution split a
# hot join partition even where the aggregate above would otherwise reuse the join's partitioning.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# A task that reads so many bytes of files, or of a shuffle, holds a few times that in the hash tables of
# its aggregates and sorts, however large the tables are. A cluster's smaller settings stay.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20}
# Shuffles are dealt this finely at least, before adaptive execution puts small partitions together.
FINE_PARTITIONS = 1000


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; other sizing settings stay the cluster's."""
    wanted = dict(RUNTIME_SETTINGS)
    for key, most in TASK_BYTES.items():
        if _bytes(spark, spark.conf.get(key)) > most:
            wanted[key] = f"{most}b"
    dealt = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    if int(dealt or 0) < FINE_PARTITIONS:
        wanted["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(FINE_PARTITIONS)
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def local_session(app: str, cores: int = 8, **conf: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Files of shuffles are otherwise deleted when the driver's garbage collector comes upon them, which may be never.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Scratch files and tables are read a few times at most: a third smaller than by the default.
COMPRESSION = "zstd"
# By session: the setting before, and how many blocks are inside.
_dropping: dict[str, tuple[str | None, int]] = {}
_dropping_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is started inside gives the files of its shuffles back when it is done. It is for DataFrames that run once:
    one that runs again makes them again. Threads may share a session: the last one out restores its setting."""
    session = spark._jsparkSession.sessionUUID()
    with _dropping_lock:
        before, inside = _dropping.get(session) or (spark.conf.get(DROP_SHUFFLES, None), 0)
        _dropping[session] = before, inside + 1
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            before, inside = _dropping.pop(session)
            if inside > 1:
                _dropping[session] = before, inside - 1
            elif before is None:
                spark.conf.unset(DROP_SHUFFLES)
            else:
                spark.conf.set(DROP_SHUFFLES, before)


_local_root: list[str] = []
_scratch: list[str] = []
_blocks = threading.local()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder named in `spark.checkpoint.dir`.

    Executors must all see the folder, so a cluster has to name one; only a local master may fall
    back to this machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="run-"))
        root = _local_root[0]
    folder = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _scratch.append(folder)
    for block in getattr(_blocks, "open", [])[-1:]:
        block.append(folder)
    return folder


@contextmanager
def scratch_cleared(spark: SparkSession) -> Iterator[None]:
    """The scratch folders that are handed out inside, to this thread, are deleted at the end."""
    _blocks.open = [*getattr(_blocks, "open", []), []]
    try:
        yield
    finally:
        *_blocks.open, own = _blocks.open
        clear_scratch(spark, own)


def once(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a scratch table, so that all who read it compute it once; the files of its shuffles go."""
    path = scratch_dir(df.sparkSession, purpose)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_folders() -> list[str]:
    """The scratch folders handed out so far and not deleted since."""
    return list(_scratch)


def clear_scratch(spark: SparkSession, folders: list[str] | None = None) -> None:
    """Delete scratch folders, by default all that are left; DataFrames that read them can no longer run."""
    for folder in scratch_folders() if folders is None else folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        if folder in _scratch:
            _scratch.remove(folder)
