"""Drift of landed documents from the read schema: fields it does not know, and shapes it cannot read.

Documents are parsed as VARIANT and opened level by level, only where the read schema has an object or a list. What it knows is
dropped at once; an unknown field or a wrong shape is kept with its path and not opened further. The number of levels is
that of the schema, and one shuffle of the finds, counted before it, makes the report.

Leaves are text in the read schemas, so numbers, texts and flags all fit them; an object or a list does not, unless the path is
named in ``any_shape``. NULL fits everything.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

OBJECT, ARRAY, LEAF = "OBJECT", "ARRAY", "LEAF"


def known_paths(kind: DataType, path: str = "") -> dict[str, str]:
    """Every path of a read schema with its shape; ``[]`` stands for the elements of a list."""
    if isinstance(kind, StructType):
        inner = {p: k for f in kind.fields for p, k in known_paths(f.dataType, f"{path}.{f.name}".lstrip(".")).items()}
        return {path: OBJECT} | inner
    if isinstance(kind, ArrayType):
        return {path: ARRAY} | known_paths(kind.elementType, f"{path}[]")
    return {path: LEAF}


def _depth(kind: DataType) -> int:
    if isinstance(kind, StructType):
        return 1 + max((_depth(f.dataType) for f in kind.fields), default=0)
    return 1 + _depth(kind.elementType) if isinstance(kind, ArrayType) else 0


def _judged(rows: DataFrame, known: dict[str, str], any_shape: Collection[str]) -> DataFrame:
    """Rows that drift, with their ``problem``, and those to be opened, without one."""
    paths = {shape: [p for p, s in known.items() if s == shape] for shape in (OBJECT, ARRAY, LEAF)}
    shape = F.substring_index(F.substring_index(F.schema_of_variant("node"), "<", 1), "(", 1)
    path, container = F.col("path"), F.col("shape").isin(OBJECT, ARRAY)

    def among(names: Collection[str]) -> Column:
        return path.isin(*names) if names else F.lit(False)

    wrong = (
        (among(paths[OBJECT]) & (F.col("shape") != OBJECT))
        | (among(paths[ARRAY]) & (F.col("shape") != ARRAY))
        | (among([p for p in paths[LEAF] if p not in any_shape]) & container)
    )
    problem = F.when(~among(list(known)), "unknown").when((F.col("shape") != "VOID") & wrong, "retyped")
    fresh = F.col("problem").isNull()
    return (
        rows.withColumn("shape", F.when(fresh, shape))
        .withColumn("found", F.when(fresh & problem.isNotNull(), F.col("shape")).otherwise(F.col("found")))
        .withColumn("problem", F.coalesce("problem", problem))
        .filter(F.col("problem").isNotNull() | (container & ~among(paths[LEAF])))
        .withColumn("node", F.when(F.col("problem").isNull(), F.col("node")))
        .drop("shape")
    )


def drift(raw: DataFrame, schema: StructType, column: str = "doc", any_shape: Collection[str] = ()) -> DataFrame:
    """(path, problem, found, documents, occurrences) of what a read with ``schema`` would lose or misread.

    ``problem`` is ``unknown`` (a field that the schema lacks), ``retyped`` (another shape than the schema's) or ``unreadable``
    (NULL, or no JSON; its path is empty). ``found`` is the JSON shape or type. Without drift, or without documents, there are no
    rows. A dot in a field's name looks like a step of its path.
    """
    spark = raw.sparkSession
    known = known_paths(schema)
    node = F.try_parse_json(F.col(column))
    text = F.lit(None).cast("string")
    rows = raw.select(
        # names a document within this job only
        F.monotonically_increasing_id().alias("document"), F.lit("").alias("path"), node.alias("node"),
        F.when(node.isNull(), "unreadable").alias("problem"), text.alias("found"),
    )
    rows = _judged(rows, known, any_shape)
    for _ in range(_depth(schema)):
        opened = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("node").outer()))
        step = F.when(F.col("key").isNull(), F.concat("path", F.lit("[]"))).otherwise(F.concat_ws(".", F.nullif("path", F.lit("")), "key"))
        old = F.col("problem").isNotNull()
        rows = opened.filter(old | F.col("pos").isNotNull()).select(
            "document", F.when(old, F.col("path")).otherwise(step).alias("path"), F.col("value").alias("node"), "problem", "found"
        )
        rows = _judged(rows, known, any_shape)
    finds = ["path", "problem", "found"]
    return (
        rows.filter("problem IS NOT NULL")
        .groupBy(*finds, "document").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*finds).agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("occurrences"))
    )


def landed_drift(
    spark: SparkSession, folders: list[str], schema: StructType, multi_line: bool = True, any_shape: Collection[str] = ()
) -> DataFrame:
    """``drift`` of the files in landing folders; with ``multi_line`` False every line that is not blank is a document."""
    raw = spark.read.text(folders, wholetext=multi_line)
    return drift(raw if multi_line else raw.filter(F.trim("value") != ""), schema, "value", any_shape)
