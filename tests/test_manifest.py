import datetime as dt

import pytest
from league_files import game, land, schedule
from pyspark.sql import functions as F

from leaguelake import schemas
from leaguelake.sources import documents, manifest


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def schedules(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("bronze")
    land(root / "2026-01-01" / "schedule_league_raw.json", schedule([("01/01/2026 00:00:00", [game("0022500001")])]))
    land(
        root / "2026-01-02" / "schedule_league_raw.json",
        schedule(
            [
                ("01/01/2026 00:00:00", [game("0022500001"), game("", 3), game(None, 3), game("0022500002", 1)]),
                ("TBD", [game("0022500008")]),
                ("01/02/2026 00:00:00", [game("0022500003", "3")]),
                ("01/01/2026 00:00:00", [game("0022500009")]),
                ("01/03/2026 00:00:00", []),
            ]
        ),
    )
    return documents.read_documents(spark, str(root / "*" / "*.json"), schemas.SCHEDULE_DOCUMENT)


def test_landing_date_comes_from_the_path(schedules):
    assert pairs(schedules, "dt") == [(dt.date(2026, 1, 1),), (dt.date(2026, 1, 2),)]


def test_latest_snapshot(schedules, spark):
    assert pairs(documents.latest_snapshot(schedules), "dt") == [(dt.date(2026, 1, 2),)]
    with pytest.raises(FileNotFoundError):
        documents.require_rows(documents.latest_snapshot(schedules.filter("false")), "schedule")


def test_wanted_games_take_the_first_listing_of_a_day(schedules):
    wanted = manifest.wanted_games(documents.latest_snapshot(schedules))
    first, second = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    assert pairs(wanted, "dt", "game_id") == [
        (first, ""), (first, "0022500001"), (first, "0022500002"), (first, None), (second, "0022500003"),
    ]


def test_completed_games(schedules):
    done = manifest.completed_games(documents.latest_snapshot(schedules))
    first, second = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    assert pairs(done, "dt", "game_id") == [(first, "0022500001"), (first, "0022500009"), (second, "0022500003")]


def test_missing_games_go_by_game_id(spark, schedules):
    done = manifest.completed_games(documents.latest_snapshot(schedules))
    files = spark.createDataFrame([("/lake/2026-01-01/boxscore_0022500001.json",), ("/lake/2026-01-01/notes.json",)], "path string")
    landed = files.select(documents.path_game_id(F.col("path")).alias("game_id"))
    assert pairs(manifest.missing_games(done, landed), "game_id") == [("0022500003",), ("0022500009",)]


def test_pending_dates(spark):
    days = lambda *values: spark.createDataFrame([(v,) for v in values], "dt string")
    out = manifest.pending_dates(days("d1", "d2", "d3", "d3"), days("d1", "d3"), days("d1", "d2"))
    assert pairs(out, "dt", "need_boxscores", "need_players") == [("d2", True, False), ("d3", False, True)]


def test_ingest_audit(spark):
    wanted = spark.createDataFrame([("d1", "a"), ("d1", "b"), ("d1", "c"), ("d2", "d")], "dt string, game_id string")
    start = dt.datetime(2026, 1, 2)
    landed = spark.createDataFrame(
        [("a", dt.datetime(2026, 1, 1)), ("b", dt.datetime(2026, 1, 3))], "game_id string, landed_at timestamp_ntz"
    )
    out = manifest.ingest_audit(wanted, landed, start)
    assert pairs(out, "dt", "wanted", "landed", "skipped", "failed", "none_landed") == [
        ("d1", 3, 1, 1, 1, False), ("d2", 1, 0, 0, 1, True), (None, 4, 1, 1, 2, False),
    ]
    with pytest.raises(ValueError, match="d2"):
        manifest.require_landed(out)
    manifest.require_landed(manifest.ingest_audit(wanted.filter("dt = 'd1'"), landed, start))


def candidates(spark, sizes):
    rows = []
    for priority, (source, size) in enumerate(sizes):
        days = [{"gameDate": "01/01/2026 00:00:00", "games": [{"gameId": str(i)} for i in range(size)]}]
        rows.append((source, priority, {"gameDates": days if size else None}))
    kind = f"source string, priority int, leagueSchedule {schemas.SCHEDULE_DOCUMENT['leagueSchedule'].dataType.simpleString()}"
    return spark.createDataFrame(rows, kind)


def test_first_source_with_enough_games_is_chosen(spark):
    feeds = candidates(spark, [("regional", 99), ("versioned", 100), ("plain", 500), ("broken", 0)])
    report = manifest.source_report(feeds)
    assert pairs(report, "source", "total_games", "accepted", "chosen") == [
        ("broken", None, False, False), ("plain", 500, True, False), ("regional", 99, False, False),
        ("versioned", 100, True, True),
    ]
    assert pairs(manifest.choose_source(feeds), "source") == [("versioned",)]


def test_no_source_raises(spark):
    with pytest.raises(RuntimeError):
        manifest.choose_source(candidates(spark, [("regional", 99)]))


def test_parameterised_read(spark):
    games = spark.createDataFrame([("a", 3), ("b", None)], "game_id string, status int")
    text = "SELECT game_id FROM {games} WHERE status = :s"
    assert pairs(documents.read_sql(spark, text, {"s": 3}, games=games), "game_id") == [("a",)]
    assert documents.read_sql(spark, text, {"s": 9}, games=games).isEmpty()


def test_absent_table_reads_as_empty(spark, tmp_path):
    assert documents.read_table(spark, str(tmp_path / "none")) is None
    empty = documents.read_partition(spark, str(tmp_path / "none"), dt.date(2026, 1, 1), schemas.SILVER_BOXSCORES)
    assert empty.isEmpty() and empty.columns == schemas.SILVER_BOXSCORES.fieldNames()
