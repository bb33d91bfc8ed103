"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` uses ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# stored bytes of the tables for each shuffle partition to begin with; AQE joins those that turn out small
BYTES_PER_PARTITION = 4 << 20
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# AQE and file scans otherwise make one task a core, or one more, which then runs alone while the other cores wait
LEAST_PARTITIONS = ("spark.sql.adaptive.coalescePartitions.minPartitionNum", "spark.sql.files.minPartitionNum")
# stored bytes of the tables for each round of a write in rounds
BYTES_PER_ROUND = 1 << 30
# shuffle files go when their write has ended; otherwise they stay until the driver's garbage collector finds them unused
SHUFFLES_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def spread(spark: SparkSession, *paths: str) -> None:
    """Let shuffles and scans have as many partitions as the tables at ``paths`` need, never fewer than the session has.

    A fixed number makes each task's sorts, hash maps and spills grow with the tables. AQE splits only skewed partitions,
    and joins others by their stored bytes, however long the JSON text is that a task makes of them; text landed by few tasks is
    few files, read by as few.
    """
    usual = int(spark.conf.get(FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-stored_bytes(spark, *paths) // BYTES_PER_PARTITION)
    if wanted > usual:
        spark.conf.set(FIRST_PARTITIONS, wanted)
        for setting in LEAST_PARTITIONS:
            spark.conf.set(setting, max(wanted, int(spark.conf.get(setting, None) or 0)))


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files at ``paths``; what is absent has none."""
    return sum(files.getContentSummary(where).getLength() for files, where in (file_system(spark, p) for p in paths) if files.exists(where))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, object]):
    """The session with other settings for a while."""
    before = {setting: spark.conf.get(setting, None) for setting in values}
    try:
        for setting, value in values.items():
            spark.conf.set(setting, str(value))
        yield
    finally:
        for setting, value in before.items():
            spark.conf.unset(setting) if value is None else spark.conf.set(setting, value)


def in_rounds(spark: SparkSession, key: str, rounds: int, write: Callable[[Column], None]) -> None:
    """Call ``write`` with a condition on ``key`` for each of ``rounds`` shares of its values, and drop a write's shuffle files when it ends.

    A write shuffles only the rows that its condition keeps, so the disk that shuffles take at one time is that of a round, however
    large the tables are. Each round has its share of the partitions.
    """
    share = {SHUFFLES_DROPPED: "true"}
    for setting in (FIRST_PARTITIONS, *LEAST_PARTITIONS):
        if now := spark.conf.get(setting, None):
            share[setting] = -(-int(now) // rounds)
    with _settings(spark, share):
        for turn in range(rounds):
            write(F.pmod(F.xxhash64(key), F.lit(rounds)) == turn if rounds > 1 else F.lit(True))


def working_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a folder in the warehouse is set: the warehouse is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_leaguelake")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared working folder."""
    return os.path.join(working_root(spark), f"{name}-{uuid.uuid4().hex}")


def held(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table written once to the shared folder.

    Later steps read the files: they neither repeat the work nor depend on executors that may be lost.
    """
    return held_at(df, name)[0]


def held_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``held``, with the path, for callers that release it when all that reads it has run."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def file_system(spark: SparkSession, path: str):
    """The file system of a path, whatever its scheme, and the path as that system has it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def release(spark: SparkSession, *paths: str) -> None:
    """Delete held tables that nothing reads any more."""
    for path in paths:
        files, where = file_system(spark, path)
        files.delete(where, True)
