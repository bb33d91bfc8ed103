"""Steps that must stay small as the tables grow: what is shuffled, landed, cast and planned."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from leaguelake import schemas, session
from leaguelake.functions import derive
from leaguelake.operators import flatten
from leaguelake.plans import catalog, medallion
from leaguelake.sources import bridge, documents, drift

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Order tables with 40 games of five lines; a customer, a part and a supplier are unknown."""
    root = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(1997, 3, 15)
    rows = {
        "orders": ([(g, g % 4, "FPO"[g % 3], 9000.0 - 200 * g, day + dt.timedelta(days=g % 5), f"{1 + g % 5}-X") for g in range(1, 41)], ORDERS),
        "lineitem": (
            [(g, (g + n) % 7, (g * n) % 5, n, 10.0 + n, 0.05, 0.02, "NR"[g % 2], "OF"[n % 2], day) for g in range(1, 41) for n in range(1, 6)],
            LINES,
        ),
        "customer": ([(c, c) for c in range(3)], "c_custkey bigint, c_nationkey int"),
        "supplier": ([(s, f'Player "{s}"') for s in range(4)], "s_suppkey bigint, s_name string"),
        "part": ([(p, f"POS {p}") for p in range(6)], "p_partkey bigint, p_type string"),
        "nation": ([(n, f"TEAM {n}", n % 5) for n in range(25)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(r, f"CITY {r}") for r in range(5)], "r_regionkey int, r_name string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_without_a_match_is_not_cast(spark, tmp_path):
    rows = [("PT34M12.00S",), ("34:12",), ("",), (None,), ("PTM",), ("99999999999:00",)]
    spark.createDataFrame(rows, "m string").coalesce(1).write.parquet(str(tmp_path / "texts"))
    texts = spark.read.parquet(str(tmp_path / "texts"))
    minutes = texts.select(derive.minutes_played(F.col("m")).alias("n"))
    assert [r.n for r in minutes.collect()] == [34, 34, None, None, None, None]
    series = derive.with_series_wins(texts, F.col("m"), F.lit("A"), F.lit("B"))
    for df in (minutes, series):
        assert not re.search(r"(?<!else )cast\(regexp_extract", plan_of(df).replace("try_", ""))  # a failing cast costs ten times the match


def below_first_join(df):
    lines = plan_of(df).splitlines()
    first = next(i for i, line in enumerate(lines) if "Join " in line)
    return "\n".join(lines[first:])


def test_player_lines_are_joined_and_grouped_before_they_become_text(spark, tables):
    docs = bridge.boxscore_documents(spark, tables)
    assert "StructsToJson" in plan_of(docs) and "StructsToJson" not in below_first_join(docs)
    parsed = documents.parse_documents(docs, schemas.BOXSCORE_DOCUMENT)
    rows = flatten.silver_player_stats(parsed, ["dt"])
    expected = bridge.silver_player_stats(spark, tables)
    assert rows.count() == expected.count() == 100  # every other game's five lines were played
    columns = sorted(expected.columns)
    assert rows.select(columns).exceptAll(expected.select(columns)).isEmpty()


def landed_and_text(landing, docs):
    files = [os.path.join(root, name) for root, _, names in os.walk(landing) for name in names if name.startswith("part-")]
    return sum(map(os.path.getsize, files)), docs.agg(F.sum(F.octet_length("doc"))).first()[0]


def test_landed_box_scores_take_a_part_of_their_text(spark, tables):
    landed, text = landed_and_text(catalog._landed_boxscores(spark, tables), bridge.boxscore_documents(spark, tables))
    assert landed < text / 2
    assert catalog.file_scan_boxscores(spark, tables).count() == 100


def test_shuffles_begin_with_partitions_for_the_size_of_the_tables(spark, tables, monkeypatch):
    before = spark.conf.get(session.FIRST_PARTITIONS, None)
    spark.conf.unset(session.FIRST_PARTITIONS)
    try:
        catalog.REGISTRY["contract_ledger"](spark, tables)
        assert spark.conf.get(session.FIRST_PARTITIONS, None) is None  # small tables: as the session has it
        size = sum(os.path.getsize(os.path.join(f"{tables}/{t}.parquet", n)) for t in ("orders", "lineitem") for n in os.listdir(f"{tables}/{t}.parquet"))
        monkeypatch.setattr(session, "BYTES_PER_PARTITION", 100)
        catalog.REGISTRY["game_type"](spark, tables)
        assert int(spark.conf.get(session.FIRST_PARTITIONS)) >= size // 150
        monkeypatch.undo()
        wide = spark.conf.get(session.FIRST_PARTITIONS)
        catalog.REGISTRY["game_type"](spark, tables)
        assert spark.conf.get(session.FIRST_PARTITIONS) == wide  # never fewer than the session has
        session.spread(spark, f"{tables}/absent.parquet")
    finally:
        spark.conf.unset(session.FIRST_PARTITIONS)
        if before is not None:
            spark.conf.set(session.FIRST_PARTITIONS, before)


def test_loads_and_cancellations_read_a_held_snapshot(spark, tables, monkeypatch):
    read = []
    cancel = medallion.cancel

    def spied(spark, path, snapshot):
        read.extend(snapshot.inputFiles())
        cancel(spark, path, snapshot)

    monkeypatch.setattr(medallion, "cancel", spied)
    steps = catalog.cancel_replay(spark, tables).groupBy("step").count().collect()
    assert {r["step"]: r["count"] for r in steps} == {1: 40, 2: 40, 3: 40}
    assert read and not [name for name in read if tables in name]


def test_shapes_are_taken_without_a_pattern(spark, tmp_path):
    docs = [('{"game":{"gameId":"1","gameStatus":{"code":1.5},"homeTeam":[7],"x":2.5}}',), ('{"game":null}',), ("{",)]
    spark.createDataFrame(docs, "doc string").write.parquet(str(tmp_path / "docs"))
    report = drift.drift(spark.read.parquet(str(tmp_path / "docs")), schemas.BOXSCORE_DOCUMENT)
    assert {(r.path, r.problem, r.found) for r in report.collect()} == {
        ("", "unreadable", None), ("game.gameStatus", "retyped", "OBJECT"), ("game.homeTeam", "retyped", "ARRAY"), ("game.x", "unknown", "DECIMAL"),
    }
    assert "regexp_extract" not in plan_of(report)  # one pattern for every node of every document
