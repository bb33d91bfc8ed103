"""Violation counts by game equal the whole suite after any changes, and an update reads only blocks of changed games."""

import datetime as dt
import random

import pytest
from league_files import boxscore, game, land, schedule
from test_quality import BOX, FACT, PLANTED, SCHEDULE, clean, fact

from leaguelake.operators import ledger, partitions, quality
from leaguelake.plans import medallion

KINDS = {"schedule": SCHEDULE, "boxscores": BOX, "player_stats": FACT}


def frames(spark, data):
    return [
        spark.createDataFrame(data["schedule"], SCHEDULE), spark.createDataFrame(data["boxes"], BOX),
        spark.createDataFrame(data["facts"], FACT), spark.createDataFrame(data["players"], "player_id bigint"),
    ]


def as_dict(report):
    return {r.check_name: (r.kind, r.violations) for r in report.collect()}


@pytest.mark.parametrize("name", sorted(quality.CONTRACTS))
def test_counts_of_games_sum_to_the_suite(spark, name):
    table, row = PLANTED[name]
    data = clean()
    data["schedule"].append(("g3", "playoff", 1))
    data[table] += [row, row]
    tables = frames(spark, data)
    assert as_dict(quality.summed(quality.game_violations(*tables))) == as_dict(quality.contract_suite(*tables))


def test_empty_tables_and_rows_without_game(spark):
    empty = frames(spark, {"schedule": [], "boxes": [], "facts": [], "players": []})
    assert {v for _, v in as_dict(quality.summed(quality.game_violations(*empty))).values()} == {0}
    data = clean()
    data["facts"] += [fact(None, 1, "bench"), fact(None, None, "home")]
    data["boxes"].append((None, True, -1, 5, "home"))
    tables = frames(spark, data)
    assert as_dict(quality.summed(quality.game_violations(*tables))) == as_dict(quality.contract_suite(*tables))


def store(spark, paths, data):
    for name, df in zip(KINDS, frames(spark, data)):
        df.withColumn(partitions.BLOCK, partitions.block_of("game_id")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy(partitions.BLOCK).parquet(paths[name])
    spark.createDataFrame(data["players"], "player_id bigint").write.mode("overwrite").parquet(paths["players"])


def test_equals_the_suite_after_random_changes(spark, tmp_path):
    rng = random.Random(5)
    paths = {name: str(tmp_path / name) for name in (*KINDS, "players")}
    counts = str(tmp_path / "counts")
    games = [f"g{i}" for i in range(12)]

    def rows_of(g):
        box = (g, rng.random() < 0.7, rng.choice([-1, 50, 90, None]), rng.choice([70, 99]), rng.choice(["home", "away", "tie"]))
        lines = [fact(g, rng.randint(1, 6), rng.choice(["home", "away", "bench"]), fg_pct=rng.choice([0.5, 2.0])) for _ in range(rng.randint(0, 4))]
        listed = (g, rng.choice(["regular", "cup"]), rng.choice([1, 3]))
        return [listed] * (rng.random() < 0.8), [box] * (rng.random() < 0.8), lines

    state = {g: rows_of(g) for g in games}
    changed, players = games, [1, 2]
    for _ in range(4):
        parts = list(zip(*state.values()))
        data = {k: [row for rows in part for row in rows] for k, part in zip(("schedule", "boxes", "facts"), parts)}
        data["players"] = [(p,) for p in players]
        store(spark, paths, data)
        ledger.update(spark, counts, spark.createDataFrame([(g,) for g in changed], "game_id string"), paths)
        assert as_dict(ledger.report(spark, counts)) == as_dict(quality.contract_suite(*frames(spark, data)))
        assert ledger.offenders(spark, counts).groupBy().sum("violations").first()[0] == sum(v for _, v in as_dict(ledger.report(spark, counts)).values())
        changed = rng.sample(games, 4)
        state |= {g: rows_of(g) for g in changed}
        players.append(players[-1] + 1)  # a player comes whose lines were already there


def test_recount_reads_only_blocks_of_changed_games(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in (*KINDS, "players")}
    data = clean()
    data["schedule"] += [(f"s{i}", "regular", 1) for i in range(60)]
    store(spark, paths, data)
    changed = spark.createDataFrame([("g1",)], "game_id string")
    plan = ledger.recount(spark, changed, paths)._jdf.queryExecution().toString()
    block = changed.select(partitions.block_of("game_id")).first()[0]
    scans = [line for line in plan.split("== Physical Plan ==")[1].splitlines() if "FileScan" in line and "game_id" in line]
    assert len(scans) >= 3 and all(f"{partitions.BLOCK}#" in s and f" = {block})" in s.split("PartitionFilters")[1] for s in scans)


def test_refresh_counts_changed_games_only(spark, tmp_path, monkeypatch):
    lake = medallion.Lake(str(tmp_path / "lake"), min_games=1)
    root = tmp_path / "lake"
    day = "01/01/2026 00:00:00"
    games = [game(f"002250000{i}") for i in range(1, 5)]
    land(root / "bronze/schedule/2026-01-01/s.json", schedule([(day, games)]))
    for i in range(1, 4):
        land(root / f"bronze/boxscores/2026-01-01/boxscore_002250000{i}.json", boxscore(f"002250000{i}"))
    first = as_dict(medallion.refresh(spark, lake))
    assert first["final_game_has_boxscore"] == ("completeness", 1)
    counted = []
    recount = ledger.recount
    monkeypatch.setattr(ledger, "recount", lambda spark, games, tables: counted.extend(r[0] for r in games.collect()) or recount(spark, games, tables))
    land(root / "bronze/boxscores/2026-01-02/boxscore_0022500004.json", boxscore("0022500004", home_score=50))
    # a run lost before its check: what it changed is still noted
    medallion.build_silver_games(spark, lake, dt.date(2026, 1, 2))
    medallion.load_gold(spark, lake, dt.date(2026, 1, 2))
    after = as_dict(medallion.refresh(spark, lake, since=dt.date(2026, 1, 2)))
    assert set(counted) == {"0022500004"}
    assert after["final_game_has_boxscore"][1] == 0 and after["final_scores_plausible"][1] == 1
    counted.clear()
    assert as_dict(medallion.check_gold(spark, lake)) == after and not counted
    assert as_dict(medallion.check_gold(spark, lake, whole=True)) == after and len(counted) == 4
    assert [(r.game_id, r.check_name) for r in ledger.offenders(spark, lake.path("contracts", "games")).filter("check_name = 'final_scores_plausible'").collect()] == [("0022500004", "final_scores_plausible")]
