"""Order-dependent work on groups of any size.

A plain window puts a whole group into one task. Here rows are numbered by a range-partitioned sort, so one group
spreads over many tasks, and are then cut into blocks of a fixed length. Results are exact, and every group, large or
small, takes the same way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from leaguelake.session import held

# rows of a block, besides those that its windows look back to
BLOCK_ROWS = 100_000
# rows per slice of a range-partitioned sort
SLICE_ROWS = 2_000_000


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Exact 1-based row number within each group, with no task ever holding a whole group.

    ``order`` is to tell any two rows of a group apart. Rows are range-partitioned on (group, order) and written
    out with the slice they fell into, which fixes it. A row's number is its place in its slice plus the rows
    the group has in earlier slices; those sums come from one count per (slice, group). The number of slices
    grows with the rows, so a slice fits in a task.
    """
    group, order = list(group), list(order)
    rows = held(df, "rows")
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(usual, math.ceil(rows.count() / SLICE_ROWS))
    sliced = held(
        rows.repartitionByRange(slices, *group, *order).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    counts = sliced.groupBy("_slice", *group).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_slice").alias("_o_slice"),
        *[F.col(g).alias(f"_o_{g}") for g in group],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy("_slice", *group).orderBy(*order)
    numbered = sliced.withColumn("_place", F.row_number().over(within))
    match = reduce(
        lambda a, b: a & b,
        (numbered[g].eqNullSafe(offsets[f"_o_{g}"]) for g in group),
        numbered["_slice"] == offsets["_o_slice"],
    )
    return numbered.join(offsets, match).select(
        *df.columns, (F.col("_before") + F.col("_place")).cast("bigint").alias(name)
    )


def over_preceding(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    columns: dict[str, Callable[[WindowSpec], Column]],
    reach: int,
    limit: int | None = None,
) -> DataFrame:
    """Window columns that look back at most ``reach`` rows, for groups of any size.

    ``columns`` maps a name to a function of the ordered window. Groups are cut into blocks of ``limit`` rows (BLOCK_ROWS
    when not given); each block also gets the last ``reach`` rows of the block before it, so every row sees exactly the
    rows a single window would show it.
    """
    limit = max(BLOCK_ROWS if limit is None else limit, reach)
    place = F.col("_rn") - 1
    own = F.expr(f"(_rn - 1) div {limit}")
    is_tail = place % limit >= limit - reach
    blocks = (
        number_rows(df, group, order, "_rn")
        .withColumn("_own", own)
        .withColumn("_block", F.explode(F.when(is_tail, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    )
    window = Window.partitionBy(*group, "_block").orderBy("_rn")
    seen = blocks.withColumns({name: build(window) for name, build in columns.items()})
    return seen.filter("_own = _block").select(*df.columns, *columns)
