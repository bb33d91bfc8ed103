"""Box scores of all lines are made in rounds whose shuffle files go with them."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from leaguelake import session
from leaguelake.plans import catalog
from leaguelake.sources import bridge

DAY = dt.datetime(1997, 3, 15)
GAMES, LINES = 60, 4


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Games with lines of known and unknown players, one without a game, and rows without values."""
    root = str(tmp_path_factory.mktemp("tables"))
    line = lambda g, n: (g, (g + n) % 7, (g * n) % 5, n, 10.0 + n, 0.05, 0.02, "NR"[g % 2], "OF"[n % 2])
    lines = [line(g, n) for n in range(1, LINES + 1) for g in range(1, GAMES + 1)]
    lines += [line(1001, 1), (None, 1, 1, 1, 1.0, 0.0, 0.0, "R", "O"), (3, None, None, None, None, None, None, None, None)]
    rows = {
        "orders": (
            [(g, g % 4, "FPO"[g % 3], 9000.0, DAY, f"{1 + g % 5}-X") for g in range(1, GAMES + 1)],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "lineitem": (
            lines,
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
            "l_returnflag string, l_linestatus string",
        ),
        "customer": ([(c, c) for c in range(3)], "c_custkey bigint, c_nationkey int"),
        "supplier": ([(s, f"Player {s}") for s in range(4)], "s_suppkey bigint, s_name string"),
        "part": ([(p, f"POS {p}") for p in range(6)], "p_partkey bigint, p_type string"),
        "nation": ([(n, f"TEAM {n}", n % 5) for n in range(25)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(r, f"CITY {r}") for r in range(5)], "r_regionkey int, r_name string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{root}/{name}.parquet")
    return root


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def left_over(spark, before):
    for _ in range(100):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def in_some_rounds(monkeypatch, tables):
    stored = sum(os.path.getsize(f"{tables}/{t}.parquet/{n}") for t in ("orders", "lineitem") for n in os.listdir(f"{tables}/{t}.parquet"))
    monkeypatch.setattr(session, "BYTES_PER_ROUND", stored // 3)
    turns, given = [], session.in_rounds

    def spied(spark, key, rounds, write):
        given(spark, key, rounds, lambda wanted: (turns.append(rounds), write(wanted)))

    monkeypatch.setattr(catalog, "in_rounds", spied)
    return turns


@pytest.mark.parametrize("name", ["player_lines", "file_scan_boxscores"])
def test_no_shuffle_of_box_scores_stays_on_disk(spark, tables, monkeypatch, name):
    expected = bridge.silver_player_stats(spark, tables).drop("dt").collect()
    settings = (session.SHUFFLES_DROPPED, session.FIRST_PARTITIONS, *session.LEAST_PARTITIONS)
    as_set = [spark.conf.get(s, None) for s in settings]
    turns = in_some_rounds(monkeypatch, tables)
    before = shuffle_files(spark)
    rows = catalog.REGISTRY[name](spark, tables)
    found = rows.select(expected[0].__fields__).collect()
    assert left_over(spark, before) == set()
    assert len(turns) == turns[0] >= 3
    assert [spark.conf.get(s, None) for s in settings] == as_set
    assert sorted(map(repr, found)) == sorted(map(repr, expected)) and len(found) == GAMES * LINES // 2 + 1
    assert not [f for f in rows.inputFiles() if tables in f]  # nothing is left to be shuffled


def test_every_source_reads_the_share_of_a_round(spark, tables):
    wanted = F.pmod(F.xxhash64("game_no"), F.lit(3)) == 1
    plan = bridge.boxscore_rows(spark, tables, wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(l_orderkey") == 2 and plan.count("xxhash64(o_orderkey") == 1
    assert "lpad(cast((" not in plan  # minutes are made with the text, not shuffled


def test_landed_player_lines_take_less_than_with_a_fast_codec(spark, tables, tmp_path):
    size = lambda top: sum(os.path.getsize(f"{d}/{n}") for d, _, names in os.walk(top) for n in names if n.startswith("part-"))
    bridge.boxscore_documents(spark, tables).select("doc").coalesce(1).write.option("compression", "lz4").text(f"{tmp_path}/fast")
    assert size(catalog._landed_boxscores(spark, tables)) < size(f"{tmp_path}/fast")
