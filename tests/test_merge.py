import datetime as dt

import pytest
from pyspark.sql import functions as F

from leaguelake import schemas
from leaguelake.operators import merge, quality


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [("a", 1, "x", 100, 1), ("b", 2, None, None, 1)], "k string, v int, w string, poll bigint, ver int"
    )


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([("b", None, "y", 2), ("c", 3, "z", 2)], "k string, v int, w string, ver int")


def test_upsert_inserts_and_overwrites_with_null(target, batch):
    out = merge.upsert(target, batch, "k", ["v", "w", "ver"])
    assert rows(out, "k", "v", "w", "poll", "ver") == [
        ("a", 1, "x", 100, 1), ("b", None, "y", None, 2), ("c", 3, "z", None, 2),
    ]


def test_upsert_twice_is_once(target, batch):
    once = merge.upsert(target, batch, "k", ["v", "w", "ver"])
    twice = merge.upsert(once, batch.orderBy(F.desc("k")), "k", ["v", "w", "ver"])
    assert rows(once, *target.columns) == rows(twice, *target.columns)


def test_upsert_keeps_columns_outside_update(target, batch):
    out = merge.upsert(target, batch, "k", ["v"])
    assert rows(out, "k", "w", "poll") == [("a", "x", 100), ("b", None, None), ("c", "z", None)]


def test_older_version_changes_nothing(target, spark):
    old = spark.createDataFrame([("a", 9, "old", 0), ("d", 4, "new", 0)], "k string, v int, w string, ver int")
    out = merge.upsert(target, old, "k", ["v", "w", "ver"], version="ver")
    assert rows(out, "k", "v") == [("a", 1), ("b", 2), ("d", 4)]


def test_upsert_into_empty_table(spark, batch, target):
    out = merge.upsert(merge.empty_table(spark, target.schema), batch, "k", ["v", "w", "ver"])
    assert rows(out, "k", "v") == [("b", None), ("c", 3)]


def test_latest_per_key_keeps_nulls_of_the_newest(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, None), ("b", 1, 7)], "k string, dt int, v int"
    )
    assert rows(merge.latest_per_key(df, ["k"], "dt"), "k", "dt", "v") == [("a", 2, None), ("b", 1, 7)]


def test_keep_first_limits_each_key_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = merge.keep_first(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_shuffle


def test_add_missing(spark):
    df = spark.createDataFrame([(1, True)], "k int, is_cancelled boolean")
    out = merge.add_missing(df, schemas.GOLD_SCHEDULE_EXTRAS)
    assert out.dtypes == [("k", "int"), ("is_cancelled", "boolean"), ("poll_message_id", "bigint")]
    assert tuple(out.first()) == (1, True, None)


def test_key_violations(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(quality.key_violations(df, ["k"]), "k", "n_rows") == [("a", 2), (None, 1)]


def test_patch_column_sets_and_clears(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    patch = spark.createDataFrame([("a", None), ("c", 3)], "k string, v int")
    assert rows(merge.patch_column(target, patch, "k", "v"), "k", "v") == [("a", None), ("b", 2), ("c", 3)]


def test_repeated_patches_and_snapshot_rows_do_not_multiply(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    patch = spark.createDataFrame([("a", 5), ("a", 7), ("a", None)], "k string, v int")
    assert rows(merge.patch_column(target, patch, "k", "v"), "k", "v") == [("a", 7), ("b", 2)]
    games = spark.createDataFrame([schedule_row("g", 1)], "game_id string, game_type string, game_status int, home_series_wins int, away_series_wins int, is_cancelled boolean")
    assert merge.cancel_phantoms(games, games.unionByName(games)).count() == 1


def test_latest_per_key_is_a_total_order(spark):
    df = spark.createDataFrame([("a", 1, i) for i in (5, 3, 9, 4)], "k string, dt int, v int")
    assert {merge.latest_per_key(df.orderBy(order), ["k"], "dt").first().v for order in ("v", F.desc("v"))} == {3}


def test_reserve_once(spark):
    wanted = spark.createDataFrame([("d1", "p"), ("d1", "p"), ("d1", "r"), ("d2", "p")], "sent_date string, channel string")
    ledger = spark.createDataFrame([("d1", "r")], "sent_date string, channel string")
    keys = ["sent_date", "channel"]
    won = merge.reserve_once(wanted, ledger, keys)
    assert rows(won, *keys) == [("d1", "p"), ("d2", "p")]
    assert merge.reserve_once(wanted, ledger.unionByName(won), keys).count() == 0


def schedule_row(game_id, status, wins=(None, None), cancelled=False, kind="playoff"):
    return (game_id, kind, status, wins[0], wins[1], cancelled)


def test_cancel_phantoms(spark):
    kind = "game_id string, game_type string, game_status int, home_series_wins int, away_series_wins int, is_cancelled boolean"
    schedule = spark.createDataFrame(
        [
            schedule_row("gone", 1),
            schedule_row("won", 1, (4, 1)),
            schedule_row("open", 1, (3, 3)),
            schedule_row("unknown wins", 1),
            schedule_row("played", 3, (4, 0)),
            schedule_row("no status", None, (4, 0)),
            schedule_row("regular gone", 1, kind="regular"),
            schedule_row("already", 1, (4, 1), cancelled=True),
            schedule_row("flag unknown", 1, (4, 1), cancelled=None),
            schedule_row("listed again", 1, (3, 1), cancelled=True),
            schedule_row("regular listed", 1, cancelled=True, kind="regular"),
        ],
        kind,
    )
    listed = schedule.filter("game_id not in ('gone', 'regular gone')")
    out = {r.game_id: (r.is_cancelled, r.newly_cancelled) for r in merge.cancel_phantoms(schedule, listed).collect()}
    assert out == {
        "gone": (True, True), "won": (True, True), "open": (False, False), "unknown wins": (False, False),
        "played": (False, False), "no status": (False, False), "regular gone": (False, False),
        "already": (True, False), "flag unknown": (True, True), "listed again": (False, False), "regular listed": (False, False),
    }


def line(game, player, day, side="home", pts=1, name="n"):
    return (game, player, dt.date(2026, 1, day), side, name, "G", "1", "10:00", pts)


def test_dimension_and_facts_keep_first(spark):
    kind = "game_id string, player_id bigint, dt date, side string, player_name string, position string, starter string, minutes string, pts int"
    lines = spark.createDataFrame(
        [
            line("g1", 7, 1, "away", 5, "old"), line("g1", 7, 1, "home", 6, "first"),
            line("g2", 7, 2, "away", 7, "newest"), line("g2", 8, 2), line("g2", 8, 2),
        ],
        kind,
    )
    assert rows(merge.players_dimension(lines), "player_id", "player_name") == [(7, "newest"), (8, "n")]
    facts = merge.player_facts(lines)
    assert rows(facts, "pk", "pts", "starter") == [("g1_7", 6, True), ("g2_7", 7, True), ("g2_8", 1, True)]
    assert "player_name" not in facts.columns


def test_assert_schema(spark):
    merge.assert_schema(merge.empty_table(spark, schemas.SILVER_BOXSCORES), schemas.SILVER_BOXSCORES)
    with pytest.raises(ValueError):
        merge.assert_schema(spark.range(1), schemas.SILVER_BOXSCORES)
