"""Large groups: the split path must give exactly what one window over the whole group gives."""

import pytest
from pyspark.sql import Window, functions as F

from leaguelake.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 rows, half of them in one group, one NULL group, unique order."""
    return (
        spark.range(5000)
        .select(
            F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 50 == 1, None)
            .otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
            (F.col("id") * 7919 % 5003).alias("o"),
            (F.col("id") % 97).alias("v"),
        )
        .repartition(6)
    )


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_number_rows(skewed):
    numbered = ordered.number_rows(skewed, ["g"], [F.col("o")], "rn")
    plain = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("bigint"))
    assert pairs(numbered, "g", "o", "v", "rn") == pairs(plain, "g", "o", "v", "rn")


def test_hot_group_spreads_over_slices(spark, skewed):
    sizes = (
        skewed.repartitionByRange(8, "g", "o").withColumn("s", F.spark_partition_id()).groupBy("s").count().collect()
    )
    assert max(r["count"] for r in sizes) < 2500


@pytest.mark.parametrize("limit", [5, 64, 10_000])
def test_over_preceding(skewed, limit):
    columns = {
        "mean": lambda w: F.avg("v").over(w.rowsBetween(-4, 0)),
        "before": lambda w: F.lag("v").over(w),
    }
    split = ordered.over_preceding(skewed, ["g"], [F.col("o")], columns, reach=4, limit=limit)
    window = Window.partitionBy("g").orderBy("o")
    plain = skewed.withColumns({name: build(window) for name, build in columns.items()})
    assert pairs(split, "g", "o", "mean", "before") == pairs(plain, "g", "o", "mean", "before")
