import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from leaguelake import schemas
from leaguelake.operators import merge, partitions, quality
from leaguelake.session import file_system, scratch_path, working_root
from leaguelake.sources import documents

KIND = "k string, v int, day string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def load(spark, path, *values, version=None, kind=KIND, **kw):
    partitions.merge(spark, path, spark.createDataFrame(list(values), kind), "k", version, **kw)


def pruned(df):
    """The partition filters and the number of files of the plan's scan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)


def files_of(spark, path):
    files, root = file_system(spark, path)
    out = {}
    for folder in files.listStatus(root):
        if folder.isDirectory():
            out[folder.getPath().getName()] = sorted(f.getPath().getName() for f in files.listStatus(folder.getPath()))
    return out


def test_replace_touches_only_its_partitions(spark):
    path = scratch_path(spark, "t")
    assert partitions.read(spark, path) is None
    partitions.replace(spark.createDataFrame([(1, "d1"), (2, "d1"), (3, "d2")], "v int, dt string"), path)
    before = files_of(spark, path)
    partitions.replace(spark.createDataFrame([(9, "d2"), (8, "d3")], "v int, dt string"), path)
    assert rows(partitions.read(spark, path), "v", "dt") == [(1, "d1"), (2, "d1"), (8, "d3"), (9, "d2")]
    after = files_of(spark, path)
    assert after["dt=d1"] == before["dt=d1"] and after["dt=d2"] != before["dt=d2"]
    # any reader opens it by path, also one partition
    assert spark.read.parquet(f"{path}/dt=d2").count() == 1


def test_a_later_run_may_add_a_column(spark):
    path = scratch_path(spark, "t")
    partitions.replace(spark.createDataFrame([(1, dt.date(2026, 1, 1)), (2, dt.date(2026, 1, 2))], "v int, dt date"), path)
    partitions.replace(spark.createDataFrame([(5, "new", dt.date(2026, 1, 2))], "v int, extra string, dt date"), path)
    stored = partitions.read(spark, path)
    assert stored.schema["dt"].dataType == schemas.DATE
    assert rows(stored, "v", "extra", "dt") == [(1, None, dt.date(2026, 1, 1)), (5, "new", dt.date(2026, 1, 2))]


def test_an_empty_table_has_its_schema(spark):
    path = scratch_path(spark, "t")
    kind = schemas.T.StructType([*schemas.SILVER_BOXSCORES.fields, schemas.T.StructField("dt", schemas.DATE)])
    for _ in range(2):
        partitions.create(spark, path, kind, "dt")
        empty = partitions.read(spark, path, kind)
        assert empty.isEmpty() and empty.schema["dt"].dataType == schemas.DATE
        merge.assert_schema(partitions.read(spark, path).drop("dt"), schemas.SILVER_BOXSCORES)
    partitions.replace(spark.createDataFrame([], kind), path)
    assert partitions.read(spark, path).isEmpty()


def test_one_date_is_read_from_its_partition_alone(spark):
    path = scratch_path(spark, "t")
    days = [dt.date(2026, 1, d) for d in (1, 2, 3)]
    kind = schemas.T.StructType([*schemas.SILVER_BOXSCORES.fields, schemas.T.StructField("dt", schemas.DATE)])
    partitions.replace(spark.createDataFrame([(f"g{i}", 3, *[None] * 8, d) for i, d in enumerate(days)], kind), path)
    day = documents.read_partition(spark, path, days[1], schemas.SILVER_BOXSCORES)
    assert rows(day, "game_id") == [("g1",)]
    assert any("2026-01-02" in f for f in pruned(day))
    assert documents.read_partition(spark, path, dt.date(2030, 1, 1), schemas.SILVER_BOXSCORES).isEmpty()


def test_merge_twice_is_once_and_keys_may_move(spark):
    path = scratch_path(spark, "t")
    load(spark, path, ("a", 1, "p"), ("b", 2, "p"), ("c", 3, "q"))
    for _ in range(2):
        load(spark, path, ("b", 9, "q"), ("d", 4, "r"))
        assert rows(partitions.read(spark, path), "k", "v", "day") == [("a", 1, "p"), ("b", 9, "q"), ("c", 3, "q"), ("d", 4, "r")]


def test_older_versions_change_nothing(spark):
    path = scratch_path(spark, "t")
    load(spark, path, ("a", 5, "2"), version="day")
    load(spark, path, ("a", 1, "1"), ("b", 1, "1"), version="day")
    assert rows(partitions.read(spark, path), "k", "v", "day") == [("a", 5, "2"), ("b", 1, "1")]


def test_new_columns_and_defaults_reach_stored_rows(spark):
    path = scratch_path(spark, "t")
    load(spark, path, *[(f"k{i}", i, "p") for i in range(50)])
    load(spark, path, ("k1", 5, "p", "n"), kind=KIND + ", extra string")
    assert partitions.read(spark, path).filter("extra is null").count() == 49
    load(spark, path, ("k2", 6, "p"), defaults={"flag": ("boolean", False), "poll": ("bigint", None)})
    stored = partitions.read(spark, path)
    assert stored.filter("flag = false and poll is null").count() == 50 and stored.filter("extra = 'n'").count() == 1


def test_repeated_and_missing_keys_are_refused(spark):
    for bad in ((("a", 1, "p"), ("a", 2, "p")), ((None, 1, "p"), ("b", 1, "p"))):
        with pytest.raises(quality.GateFailed, match="1 values"):
            load(spark, scratch_path(spark, "t"), *bad)


def test_an_empty_batch_makes_or_keeps_a_table(spark):
    path = scratch_path(spark, "t")
    load(spark, path)
    assert partitions.read(spark, path).isEmpty() and partitions.read(spark, path).columns == ["k", "v", "day"]
    load(spark, path, ("a", 1, "p"))
    load(spark, path)
    assert rows(partitions.read(spark, path), "k") == [("a",)]


def test_a_merge_reads_and_writes_only_the_blocks_of_its_keys(spark):
    path = scratch_path(spark, "t")
    load(spark, path, *[(f"k{i}", i, "p") for i in range(500)])
    before = files_of(spark, path)
    keys = spark.createDataFrame([("k7", 70, "p")], KIND)
    part = partitions.blocks_of(spark, path, keys, "k")
    assert any(partitions.BLOCK in f for f in pruned(part)) and part.count() < 50
    load(spark, path, ("k7", 70, "p"))
    after = files_of(spark, path)
    assert len([b for b in before if "HIVE" not in b]) == partitions.BLOCKS
    assert len([b for b in after if after[b] != before[b]]) == 1
    assert rows(partitions.read(spark, path).filter("k in ('k7', 'k8')"), "k", "v") == [("k7", 70), ("k8", 8)]


def test_a_failed_write_leaves_the_table_as_it_was(spark):
    path = scratch_path(spark, "t")
    load(spark, path, ("a", 1, "p"), ("b", 2, "p"))
    batch = spark.createDataFrame([("a", "9", "p"), ("b", "x", "q")], "k string, v string, day string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        partitions.replace(batch.withColumn("v", F.col("v").cast("int")).withColumn(partitions.BLOCK, partitions.block_of("k")), path, partitions.BLOCK)
    assert rows(partitions.read(spark, path), "k", "v") == [("a", 1), ("b", 2)]
    load(spark, path, ("a", 9, "p"))
    assert rows(partitions.read(spark, path), "k", "v") == [("a", 9), ("b", 2)]


def test_held_batches_are_deleted(spark):
    path = scratch_path(spark, "t")
    files, root = file_system(spark, working_root(spark))
    held = lambda: sum("/batch-" in s.getPath().toString() for s in files.listStatus(root))
    load(spark, path, ("a", 0, "p"))
    start = held()
    for i in range(3):
        load(spark, path, ("a", i, "p"))
    assert held() == start
    assert sum(len(names) for names in files_of(spark, path).values()) <= 4  # one block and the schema, with check sums
