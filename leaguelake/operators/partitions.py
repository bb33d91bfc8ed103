"""Stored tables: plain Parquet folders written by Spark's own writer, which any reader opens by path.

Dates, or hash blocks of a key, are partition columns. A write replaces exactly the partitions it has rows of (dynamic
partition overwrite); a read of some dates or blocks lists only those (``PartitionFilters``). Columns that came later
are merged from the files' schemas and are NULL in older ones.

Spark writes the new files beside the table and moves them when all tasks are done, so a lost executor or a failed task
changes nothing. Only a driver lost during those last renames can leave a partition to be written again: dates
from the landed files, keyed tables by a merge of all dates. One writer at a time is assumed, and a frame read before
a write is read again after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from leaguelake.operators.merge import add_missing, upsert
from leaguelake.operators.quality import GateFailed, key_violations
from leaguelake.session import file_system, held_at, release

# hash blocks of a keyed table; their number also bounds the literal list that prunes a merge
BLOCKS = 64
BLOCK = "_block"
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's name of the partition of NULL


def _stored(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return None
        raise


def read(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """Rows of a table, None if nothing was written. With ``schema`` (partition column included) no file is opened to learn it."""
    frame = _stored(spark, path, schema)
    return None if frame is None else frame.drop(BLOCK)


def read_date(spark: SparkSession, path: str, day: dt.date, schema: StructType, by: str = "dt") -> DataFrame | None:
    """One date of a table partitioned by dates, None if it has none: only that partition is listed and opened."""
    reader = spark.read.schema(schema).option("basePath", path)
    try:
        return reader.parquet(f"{path}/{by}={day.isoformat()}").filter(F.col(by) == F.lit(day))
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return None
        raise


def create(spark: SparkSession, path: str, schema: StructType, by: str) -> None:
    """An empty table: a file without rows holds the schema. An existing table stays as it is."""
    if _stored(spark, path) is None:
        columns = StructType([f for f in schema.fields if f.name != by])
        spark.createDataFrame([], columns).write.mode("append").parquet(f"{path}/{by}={NO_VALUE}")


def _is_empty(spark: SparkSession, path: str, by: str) -> bool:
    """Whether a table has no rows, from the names of its partitions; at most the file of ``create`` is opened."""
    files, root = file_system(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
    held_partitions = [n for n in names if n.startswith(f"{by}=")]
    return not held_partitions or held_partitions == [f"{by}={NO_VALUE}"] and spark.read.parquet(f"{path}/{by}={NO_VALUE}").isEmpty()


def _spread(df: DataFrame, by: str) -> DataFrame:
    """Rows dealt out for writing, few files to a partition and none too large for a task.

    Many partitions (a calendar) go by range of (partition, row hash) to the usual number of tasks, so that a small one is
    one file and a large one several tasks' work; few partitions get the sizes that AQE finds fitting.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if by != BLOCK and df.select(by).distinct().count() > usual:
        hashed = [name for name, kind in df.dtypes if not kind.startswith("map")]
        return df.repartitionByRange(usual, F.col(by), F.xxhash64(*hashed))
    return df.hint("rebalance", by)


def replace(df: DataFrame, path: str, by: str = "dt") -> None:
    """Replace the partitions of ``by`` that ``df`` has rows of.

    The first rows of a table are appended, which spares looking for partitions to replace.
    """
    writer = _spread(df, by).write
    if _is_empty(df.sparkSession, path, by):
        writer.mode("append").partitionBy(by).parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def block_of(key: str, blocks: int = BLOCKS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def touched_blocks(keys: DataFrame, key: str, blocks: int = BLOCKS) -> list[int]:
    """Blocks that hold the given keys."""
    return [r[0] for r in keys.select(block_of(key, blocks)).distinct().collect()]  # at most ``blocks``


def in_blocks(spark: SparkSession, path: str, touched: Sequence[int], schema: StructType | None = None) -> DataFrame | None:
    """Rows of some blocks, a literal list, so the others are not even listed. With ``schema`` no file is opened to learn it."""
    frame = _stored(spark, path, schema)
    return None if frame is None else frame.filter(F.col(BLOCK).isin(touched)).drop(BLOCK)


def blocks_of(spark: SparkSession, path: str, keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame | None:
    """Rows of the blocks that hold the given keys."""
    return in_blocks(spark, path, touched_blocks(keys, key, blocks))


def merge(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str,
    version: str | None,
    update: Sequence[str] | None = None,
    defaults: Mapping[str, tuple[str, object]] | None = None,
    blocks: int = BLOCKS,
    block_key: str | None = None,
) -> None:
    """Keyed merge of a batch with one row per key, reading and rewriting only the blocks of its keys.

    ``block_key`` names another column for the blocks, one that the key determines: tables with the same one lie in the same blocks.

    With ``version`` a row older than the stored one changes nothing, so batches may come in any order; None is
    for patches, which always apply. Columns that the table lacks are added; where ``defaults`` gives one a value, rows
    already stored get it too. A rerun gives the same table.
    """
    batch, place = held_at(batch, "batch")
    repeated = key_violations(batch, [key]).count()
    if repeated:
        raise GateFailed(f"batch repeats or lacks {key} ({repeated} values)")
    update = list(update) if update is not None else [c for c in batch.columns if c != key]
    defaults, block_key = defaults or {}, block_key or key
    stored = read(spark, path)
    if stored is None:
        merged = add_missing(batch, defaults)
        create(spark, path, merged.schema, BLOCK)
    else:
        given = any(defaults[c][1] is not None for c in defaults if c not in stored.columns)
        target = stored if given else blocks_of(spark, path, batch, block_key, blocks)
        kinds = {f.name: (f.dataType.simpleString(), None) for f in batch.schema.fields if f.name != key}
        merged = upsert(add_missing(add_missing(target, defaults), kinds), batch, key, update, version)
    replace(merged.withColumn(BLOCK, block_of(block_key, blocks)), path, BLOCK)
    release(spark, place)
