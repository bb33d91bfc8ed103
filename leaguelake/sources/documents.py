"""Readers: landed JSON documents, stored tables, and parameterised SQL."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from leaguelake.operators import partitions
from leaguelake.session import file_system

# landed files lie at <root>/<yyyy-MM-dd>/<file>.json
DATE_IN_PATH = r"/(\d{4}-\d{2}-\d{2})/[^/]*$"
GAME_ID_IN_PATH = r"boxscore_([^/]+)\.json$"


BROKEN = "_corrupt_record"


def read_documents(
    spark: SparkSession, paths: str | list[str], schema: StructType, multi_line: bool = True
) -> DataFrame:
    """JSON documents with an explicit schema, plus ``path`` and the landing date ``dt`` taken from it.

    ``multi_line`` reads one document per file. Set it to False for files with one document per line, which
    Spark can split. A document that is not JSON of that form has NULL fields and its text in ``_corrupt_record``.
    """
    return (
        spark.read.schema(StructType([*schema.fields, StructField(BROKEN, StringType())]))
        .option("multiLine", multi_line)
        .json(paths)
        .select("*", F.col("_metadata.file_path").alias("path"))
        .withColumn("dt", path_date(F.col("path")))
    )


def date_folders(spark: SparkSession, root: str, since: dt.date | None = None) -> list[str]:
    """Folders <root>/<yyyy-MM-dd> from ``since`` on, by name alone: one listing, at most one entry per day."""
    files, where = file_system(spark, root)
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]
    return sorted(f"{root}/{n}" for n in names if re.fullmatch(r"\d{4}-\d{2}-\d{2}", n) and (since is None or n >= since.isoformat()))


def landed_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, dt, landed_at) of the files at ``paths``, from the listing alone: no file is opened."""
    return spark.read.format("binaryFile").load(paths).select(
        "path", path_date(F.col("path")).alias("dt"), F.col("modificationTime").alias("landed_at")
    )


def path_date(path: Column) -> Column:
    """Landing date in a file path."""
    return F.regexp_extract(path, DATE_IN_PATH, 1).try_cast("date")


def path_game_id(path: Column) -> Column:
    """Game id in the name of a box score file."""
    return F.nullif(F.regexp_extract(path, GAME_ID_IN_PATH, 1), F.lit(""))


def parse_documents(raw: DataFrame, schema: StructType, column: str = "doc") -> DataFrame:
    """The same documents held as text in a column, parsed with the explicit schema into top-level fields."""
    carried = [c for c in raw.columns if c != column]
    return raw.select(*carried, F.from_json(column, schema).alias("_doc")).select(*carried, "_doc.*")


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored Parquet table, or None when nothing was written yet."""
    return partitions.read(spark, path)


def read_partition(spark: SparkSession, path: str, day: dt.date, schema: StructType) -> DataFrame:
    """One date of a table partitioned by ``dt``; an absent table or date is an empty frame.

    The schema is given and only the date's own partition is listed, so the cost does not grow with the calendar.
    """
    rows = partitions.read_date(spark, path, day, StructType([*schema.fields, StructField("dt", DateType())]))
    return spark.createDataFrame([], schema) if rows is None else rows.select(*schema.fieldNames())


def read_sql(spark: SparkSession, text: str, args: Mapping[str, object], **views: DataFrame) -> DataFrame:
    """SQL text with bound arguments over the given frames, named in the text as ``{name}``."""
    return spark.sql(text, args=dict(args), **views)


def latest_snapshot(df: DataFrame, version: str = "dt") -> DataFrame:
    """Rows of the newest snapshot."""
    newest = df.agg(F.max(version).alias(version))
    return df.join(F.broadcast(newest), version, "left_semi")  # one row


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise FileNotFoundError(f"no {what} found")
    return df
