"""Every registered query against its SQL twin: on the small tables, and on heavily skewed ones."""

import re

import pytest
import sql_compare
from pyspark.sql import functions as F

import __spark_entry__ as contract
from leaguelake.operators import ordered
from leaguelake.plans import catalog, oracle

SMALL = "/root/testdata/sf0.001"
BASE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def small(spark):
    return sql_compare.connect(SMALL)


def test_every_query_has_a_twin():
    assert set(catalog.REGISTRY) == set(oracle.SQL)
    assert set(catalog.REGISTRY) <= set(contract.queries()) and set(oracle.SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.REGISTRY))
def test_query_equals_sql(spark, small, name):
    df = contract.queries()[name](spark, SMALL)
    assert sql_compare.differences(df, small, contract.oracle_sql()[name]) == []


def test_entry(spark):
    digest = contract.entry(spark)
    assert digest.columns == ["local_date", "game_datetime_utc", "game_id", "line"]
    assert digest.count() > 0


def test_comparison_notices_a_changed_value(spark, small):
    df = contract.queries()["game_type"](spark, SMALL).withColumn(
        "game_type", F.when(F.col("game_id").endswith("77"), "x").otherwise(F.col("game_type"))
    )
    assert sql_compare.differences(df, small, contract.oracle_sql()["game_type"])


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the orders on one day, a third of the line items in one order and in one player, and 400
    copies of one line."""
    root = tmp_path_factory.mktemp("skewed")
    read = lambda t: spark.read.parquet(f"{BASE}/{t}.parquet")
    orders = read("orders").withColumn(
        "o_orderdate",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("1997-03-15").cast("timestamp_ntz")).otherwise(F.col("o_orderdate")),
    )
    place = F.col("l_partkey") % 3
    lines = read("lineitem").withColumn("l_orderkey", F.when(place == 0, 7).otherwise(F.col("l_orderkey")))
    lines = lines.withColumn("l_suppkey", F.when((F.col("l_partkey") + F.col("l_linenumber")) % 3 == 0, 3).otherwise(F.col("l_suppkey")))
    copies = lines.filter("l_returnflag <> 'N'").limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("n")
    frames = {"orders": orders, "lineitem": lines.unionByName(copies)}
    for table in sql_compare.TABLES:
        frames.get(table, read(table)).write.parquet(f"{root}/{table}.parquet")
    con = sql_compare.connect(BASE)
    for table in frames:
        con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM read_parquet('{root}/{table}.parquet/*.parquet')")
    return str(root), con


HOT = (
    "boxscore_silver player_lines completed_manifest results_message dim_players fact_player_game_stats pk_violations contract_suite "
    "results_digest results_digest_documents leaders player_form position_distribution plus_minus_context "
    "advanced_metrics ingest_audit outbox"
).split()


@pytest.mark.parametrize("name", HOT)
def test_skewed_query_equals_sql(spark, skewed, monkeypatch, name):
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 50)
    root, con = skewed
    df = contract.queries()[name](spark, root)
    assert sql_compare.differences(df, con, contract.oracle_sql()[name]) == []


def test_every_game_stays_when_there_are_more_teams(spark, tmp_path):
    """A 26th team with a tenth of the customers: no game is lost."""
    read = lambda t: spark.read.parquet(f"{SMALL}/{t}.parquet")
    team = read("nation").limit(1).withColumns({"n_nationkey": F.lit(25).cast("bigint"), "n_name": F.lit("NEW")})
    nation = read("nation").unionByName(team.select(*[F.col(c).cast(read("nation").schema[c].dataType) for c in team.columns]))
    key = read("customer").schema["c_nationkey"].dataType
    customer = read("customer").withColumn("c_nationkey", F.when(F.col("c_custkey") % 10 == 0, 25).otherwise(F.col("c_nationkey")).cast(key))
    frames = {"nation": nation, "customer": customer}
    for table in sql_compare.TABLES:
        frames.get(table, read(table)).write.parquet(f"{tmp_path}/{table}.parquet")
    for name in ("schedule_flatten", "wanted_manifest", "due_polls", "upsert_schedule"):
        assert catalog.REGISTRY[name](spark, str(tmp_path)).count() >= (1500 if name != "due_polls" else 1000), name
    assert catalog.REGISTRY["schedule_flatten"](spark, str(tmp_path)).filter("home_team_name = 'NEW'").count() > 0


def test_no_plan_holds_python_or_a_cross_product(spark):
    for name, run in catalog.REGISTRY.items():
        if name in ("incremental_silver", "partition_overwrite"):
            continue
        plan = run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", plan), name
