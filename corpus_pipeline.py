"""The corpus pipeline: documents in, packed training batches out, in stages that each call one text operator."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from leaguelake.llm import line_dedup, quality_rules, simhash_dedup, template_decontamination
from leaguelake.llm.common import table
from leaguelake.llm.packing import pack
from leaguelake.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; a document that had nothing else goes."""
    out = line_dedup.line_dedup(docs)
    emptied = (F.col("lines_dropped") > 0) & (F.trim("text") == "")
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return out.filter(~emptied).select(*[changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of similar fingerprints."""
    return simhash_dedup.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return template_decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every document that is left."""
    return pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]
# a smoothed model, connected components and chosen bucket boundaries have no SQL form; tested against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each stage is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, os.path.join("pipeline", name.replace(" ", "_")))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
