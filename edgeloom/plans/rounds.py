"""Iteration on Spark: settings, the shared folder, and the frames of a loop.

A loop writes the state of each round as a table in the shared folder and reads it back. A
lost executor then costs the current round only, plans do not grow with the rounds, and the
planner sees the true size of every state. (The estimates that a checkpointed frame carries
along multiply from round to round.) Frames that stay the same through a loop, such as its
edges, are persisted on top of such a table.
"""

from __future__ import annotations

import gc
import math
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Session settings (``spark.edgeloom.<name>``) and what they default to.
DEFAULTS = {
    "rowsPerPartition": 4_000_000,  # target size of a persisted edge partition
    "hotRows": 1_000_000,  # a key below this many rows is never split; pairs of a projection made at a time
    "pairRows": 10_000,  # rows of one group that meet each other in one task
    "broadcastRows": 50_000,  # largest table, by measured rows, that a lookup broadcasts through the driver in each round
    "topRows": 100_000,  # largest limit answered by a top-k instead of a range sort
    "stateRows": 50_000_000,  # rows of sources and nodes that the searches of one batch may reach
    "taskRows": 1_000_000,  # rows that a task joins or counts in memory
    "unionFrames": 16,  # frames of finished rounds that are read as a union before a rewrite
}


def setting(spark: SparkSession, name: str) -> int:
    return int(spark.conf.get(f"spark.edgeloom.{name}", str(DEFAULTS[name])))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partition count for a frame kept through a loop, from its measured row count.

    Usually the session's shuffle partitions, so that joins with shuffled frames line up;
    fewer for small frames, more where those partitions would outgrow memory.
    """
    by_size = math.ceil(rows / setting(spark, "rowsPerPartition"))
    return max(1, by_size, min(shuffle_partitions(spark), math.ceil(rows / 10_000)))


def even(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Shuffle ``rows`` measured rows by ``keys`` so that a task gets ``taskRows`` of them, however many there are."""
    spark = df.sparkSession
    most = setting(spark, "taskRows")
    return df if rows <= most else df.repartition(max(shuffle_partitions(spark), math.ceil(rows / most)), *keys)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local run without one gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="edgeloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, **facts: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` to the shared folder, taking aggregates of its rows on the way."""
    return _write(df, shared_folder(df.sparkSession), facts)


# Folders that this process has written.
_paths: list[str] = []


def release(spark: SparkSession, keep: DataFrame | None = None) -> int:
    """Remove the tables that this process has written, but for those that ``keep`` reads.

    Call it when the results have been used or written; returns the number of removed tables.
    """
    read = {file.rsplit("/", 1)[0].split("/table-")[-1] for file in keep.inputFiles()} if keep is not None else set()
    gone = [path for path in _paths if path.split("/table-")[-1] not in read]
    for path in gone:
        _remove(spark, path)
        _paths.remove(path)
    return len(gone)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of finished jobs now: it does so when the driver's garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _write(df: DataFrame, folder: str, facts: dict[str, Column]) -> tuple[DataFrame, dict]:
    path = f"{folder}/table-{uuid.uuid4().hex}"
    _paths.append(path)
    taken = Observation()
    if facts:
        df = df.observe(taken, *[column.alias(name) for name, column in facts.items()])
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return table, taken.get if facts else {}


class Rounds:
    """The tables and persisted frames of one loop, which it frees at its end.

    What a loop returns has to be written outside of it, by :func:`written`.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._folder = f"{shared_folder(spark)}/loop-{uuid.uuid4().hex}"
        self._kept: list[DataFrame] = []

    def __enter__(self) -> Rounds:
        return self

    def __exit__(self, *_) -> None:
        for df in self._kept:
            df.unpersist()
        _remove(self._spark, self._folder)
        _paths[:] = [path for path in _paths if not path.startswith(self._folder)]

    def written(self, df: DataFrame, **facts: Column) -> tuple[DataFrame, dict]:
        """As :func:`written`, for a table that the loop drops at its end."""
        return _write(df, self._folder, facts)

    def keep(self, df: DataFrame) -> DataFrame:
        """Persist a frame that every round reads."""
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._kept.append(kept)
        return kept
