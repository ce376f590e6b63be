"""Session settings, and intermediate tables in the shared work folder."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


#: Number of partitions to deal small input tables over; unset: as they are read.
INPUT_PARTITIONS = "spark.ratewise.inputPartitions"
#: Tables are broadcast up to this size, however low the session's threshold.
BROADCAST_BYTES = 32 << 20


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine.

    Its small tables come as one split each, so they are dealt over the cores.

    On a cluster the caller's own session is used as it is: no function of this
    package sets a shuffle width or turns adaptive execution off.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ratewise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config(INPUT_PARTITIONS, str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def fits_broadcast(spark: SparkSession, size: Callable[[], int], most: int = BROADCAST_BYTES) -> bool:
    """Whether a table of ``size`` bytes may be broadcast; not in a session that broadcasts
    nothing, where the size is not asked for."""
    if spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return False
    return size() <= most


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own. On a cluster a
    machine-local folder would be lost with its executor, so that is an error.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="ratewise-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


#: Paths handed out within each open ``work_tables`` block.
_OPEN_BLOCKS: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the work folder that no other run uses."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _OPEN_BLOCKS:
        _OPEN_BLOCKS[-1].append(path)
    return path


@contextlib.contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made within the block when it ends.

    Tables that are read lazily must have been read by then. Outside of any block
    intermediate tables stay until the work folder is emptied.
    """
    _OPEN_BLOCKS.append([])
    try:
        yield
    finally:
        for path in _OPEN_BLOCKS.pop():
            _remove(spark, path)


def durable(df: DataFrame, name: str, *partition_columns: str) -> DataFrame:
    """Write ``df`` once as Parquet in the work folder and return a scan of it.

    This cuts the lineage in a way that survives lost executors, and gives the
    planner the true size of the table, so that a later join broadcasts it only
    when it is below ``spark.sql.autoBroadcastJoinThreshold``. It runs the plan of
    ``df`` when called. A ``work_tables`` block removes the table.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.partitionBy(*partition_columns).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Remove tables that ``durable`` returned and that nothing reads any more.

    An iterative job calls this for the tables of its former rounds, so that its disk does
    not grow with their number. Shuffle files of ended queries go when the driver's objects
    of them are collected, which is asked for here.
    """
    for df in stored:
        _remove(df.sparkSession, df._stored_at)
    if stored:
        forget_shuffles(stored[0].sparkSession)


def discard_partition(stored: DataFrame, partition: str) -> None:
    """Remove one partition, such as ``kind=words``, of a table that ``durable`` returned and
    that nothing reads any more."""
    _remove(stored.sparkSession, f"{stored._stored_at}/{partition}")


def forget_shuffles(spark: SparkSession) -> None:
    """Ask for the driver's objects of ended queries to be collected, so their shuffle files go."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _remove(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
