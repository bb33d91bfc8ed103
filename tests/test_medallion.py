"""Landed multi-line JSON files through Silver and Gold, in batch and incrementally."""

import datetime as dt

import pytest
from league_files import boxscore, game, land, schedule
from pyspark.sql import functions as F

from leaguelake import schemas
from leaguelake.operators import delivery, flatten, merge, quality
from leaguelake.plans import medallion, messages
from leaguelake.sources import documents
from leaguelake.streaming import incremental

DAY = "01/01/2026 00:00:00"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def land_all(root):
    games = [game(f"002250000{i}") for i in range(1, 5)]
    phantom = game("0042500007", 1, series="BOS leads 3-1")
    won = game("0042500006", 1, series="BOS wins 4-1")
    land(root / "bronze/schedule/2026-01-01/schedule_league_raw.json", schedule([(DAY, [*games, phantom, won])]))
    changed = [dict(games[0], homeTeam={"teamName": "Celtics II", "teamCity": "Boston"}), *games[1:], won]
    land(root / "bronze/schedule/2026-01-02/schedule_league_raw.json", schedule([(DAY, changed)]))
    for i in range(1, 5):
        land(root / f"bronze/boxscores/2026-01-01/boxscore_002250000{i}.json", boxscore(f"002250000{i}"))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    land_all(root)
    lake = medallion.Lake(str(root), min_games=1)
    report = medallion.refresh(spark, lake)
    assert {r.violations for r in report.collect()} == {0}
    return lake


def test_silver_layouts(spark, lake):
    for table, schema in (
        ("schedule", schemas.SILVER_SCHEDULE), ("boxscores", schemas.SILVER_BOXSCORES),
        ("player_stats", schemas.SILVER_PLAYER_STATS),
    ):
        stored = documents.read_table(spark, lake.silver(table)).drop("dt")
        merge.assert_schema(stored, schema)


def test_gold_schedule(spark, lake):
    gold = documents.read_table(spark, lake.gold("schedule"))
    assert rows(gold.filter("is_cancelled"), "game_id") == [("0042500006",), ("0042500007",)]
    assert rows(gold.filter("game_id = '0022500001'"), "home_team_name", "snapshot") == [
        ("Celtics II", dt.date(2026, 1, 2))
    ]
    assert gold.count() == 6


def test_gold_players(spark, lake):
    assert rows(documents.read_table(spark, lake.gold("players")), "player_id") == [(1,), (2,), (3,)]
    facts = documents.read_table(spark, lake.gold("player_stats"))
    assert facts.count() == 12
    first = facts.filter("pk = '0022500001_3'").first()
    assert (first.side, first.team_id, first.starter, first.plus_minus, first.fg_pct) == ("away", 20, True, 4, 0.444)


def test_refresh_again_keeps_operational_columns(spark, lake):
    gold = lake.gold("schedule")
    messages.record_polls(spark, lake, spark.createDataFrame([("0022500002", 77), ("unknown", 5)], "game_id string, poll_message_id bigint"))
    medallion.refresh(spark, lake)
    after = documents.read_table(spark, gold)
    assert rows(after.filter("poll_message_id is not null"), "game_id", "poll_message_id") == [("0022500002", 77)]
    assert rows(after.filter("is_cancelled"), "game_id") == [("0042500006",), ("0042500007",)]
    assert after.count() == 6
    messages.record_polls(spark, lake, spark.createDataFrame([("0022500002", None)], "game_id string, poll_message_id bigint"))


def test_new_late_and_corrected_files_are_taken_in(spark, tmp_path):
    land_all(tmp_path)
    lake = medallion.Lake(str(tmp_path), min_games=1)
    first, second = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    assert rows(medallion.pending(spark, lake, "boxscores").select("dt").distinct(), "dt") == [(first,)]
    medallion.refresh(spark, lake)
    assert medallion.pending(spark, lake, "boxscores").isEmpty() and medallion.pending(spark, lake, "schedule").isEmpty()
    land(tmp_path / "bronze/boxscores/2026-01-02/boxscore_0022500004.json", boxscore("0022500004", home_score=120))
    land(tmp_path / "bronze/boxscores/2026-01-02/boxscore_0022500001.json", boxscore("0022500001", home=(1, 3)))
    assert rows(medallion.pending(spark, lake, "boxscores").select("dt").distinct(), "dt") == [(second,)]
    medallion.refresh(spark, lake, since=second)
    gold = documents.read_table(spark, lake.gold("boxscores"))
    assert rows(gold.filter("dt = '2026-01-02'"), "game_id", "home_score") == [("0022500001", 101), ("0022500004", 120)]
    assert gold.count() == 4
    # a second file in a date that is built, and a corrected one
    land(tmp_path / "bronze/boxscores/2026-01-01/boxscore_0022500009.json", boxscore("0022500009", home_score=77))
    land(tmp_path / "bronze/boxscores/2026-01-01/boxscore_0022500002.json", boxscore("0022500002", home_score=155))
    medallion.build_silver_games(spark, lake)
    medallion.load_gold(spark, lake)
    gold = documents.read_table(spark, lake.gold("boxscores"))
    assert rows(gold.filter("game_id in ('0022500009', '0022500002')"), "game_id", "home_score") == [("0022500002", 155), ("0022500009", 77)]


def test_no_cancellation_without_a_newer_snapshot(spark, tmp_path):
    lake = medallion.Lake(str(tmp_path), min_games=1)
    listed = game("0042500001", 1, series="BOS leads 3-1")
    land(tmp_path / "bronze/schedule/2026-01-01/s.json", schedule([(DAY, [listed])]))
    medallion.build_silver_schedule(spark, lake)
    for since in (None, dt.date(2026, 1, 2)):
        medallion.load_gold(spark, lake, since)
        assert rows(documents.read_table(spark, lake.gold("schedule")), "game_id", "is_cancelled") == [("0042500001", False)]


def test_a_game_that_is_listed_again_comes_back(spark, tmp_path):
    lake = medallion.Lake(str(tmp_path), min_games=1)
    both = [game("0042500001", 1, series="BOS leads 3-1"), game("0022500001")]
    flags = []
    for day, games in ((1, both), (2, both[1:]), (3, both)):
        land(tmp_path / f"bronze/schedule/2026-01-0{day}/s.json", schedule([(DAY, games)]))
        medallion.build_silver_schedule(spark, lake)
        medallion.load_gold(spark, lake, dt.date(2026, 1, day))
        flags.append(documents.read_table(spark, lake.gold("schedule")).filter("game_id = '0042500001'").first().is_cancelled)
    assert flags == [False, True, False]


def test_dates_without_players(spark, tmp_path):
    land(tmp_path / "bronze/boxscores/2026-01-01/boxscore_0022500001.json", boxscore("0022500001", home=(), away=()))
    lake = medallion.Lake(str(tmp_path), min_games=1)
    medallion.build_silver_games(spark, lake)
    assert documents.read_table(spark, lake.silver("boxscores")).count() == 1
    assert documents.read_table(spark, lake.silver("player_stats")) is None


@pytest.mark.parametrize(
    "kind, name, content, gate",
    [
        ("boxscores", "boxscore_0022500002.json", '{"game": {"gameId": "00225', "documents_readable"),
        ("schedule", "t.json", '{"leagueSchedule": {"gam', "documents_readable"),
        ("schedule", "s.json", schedule([]), "schedule_not_empty"),
        ("schedule", "s.json", schedule([(DAY, [])]), "schedule_not_empty"),
        ("schedule", "s.json", schedule([(DAY, [game("0022500001", "soon"), game("0022500002")])]), "schedule_status_typed"),
        ("schedule", "s.json", schedule([(DAY, [game("0022500001", when="TBD"), game("0022500002")])]), "schedule_start_typed"),
        ("boxscores", "boxscore_0022500001.json", boxscore("0022500001", home_score="many"), "boxscore_numbers_typed"),
        ("boxscores", "boxscore_0022500001.json", boxscore("0022500001", home_score=-1), "boxscore_scores"),
    ],
)
def test_bad_landings_stop_before_any_write(spark, tmp_path, kind, name, content, gate):
    good = tmp_path / f"bronze/{kind}/2026-01-02"
    land(good / ("s.json" if kind == "schedule" else "boxscore_0022500007.json"), schedule([(DAY, [game("0022500007")])]) if kind == "schedule" else boxscore("0022500007"))
    bad = tmp_path / f"bronze/{kind}/2026-01-01/{name}"
    if isinstance(content, str):
        bad.parent.mkdir(parents=True)
        bad.write_text(content)
    else:
        land(bad, content)
    lake = medallion.Lake(str(tmp_path), min_games=1)
    build = medallion.build_silver_schedule if kind == "schedule" else medallion.build_silver_games
    with pytest.raises(quality.GateFailed, match=f"{gate}.*dt=2026-01-01"):
        build(spark, lake)
    assert documents.read_table(spark, lake.silver(kind)) is None


def test_a_truncated_schedule_is_stopped(spark, tmp_path):
    land(tmp_path / "bronze/schedule/2026-01-01/s.json", schedule([(DAY, [game(f"00225{i:05d}") for i in range(99)])]))
    with pytest.raises(quality.GateFailed, match="schedule_complete dt=2026-01-01"):
        medallion.build_silver_schedule(spark, medallion.Lake(str(tmp_path)))


def test_ingest_report(spark, lake):
    audit = medallion.ingest_report(spark, lake, dt.datetime(2020, 1, 1))
    assert rows(audit.filter("dt is null"), "wanted", "landed", "failed") == [(4, 4, 0)]


def test_bad_schedule_stops_before_the_write(spark, tmp_path):
    twice = schedule([(DAY, [game("0022500001"), game("0022500001")])])
    land(tmp_path / "bronze/schedule/2026-01-01/schedule_league_raw.json", twice)
    lake = medallion.Lake(str(tmp_path), min_games=1)
    with pytest.raises(quality.GateFailed, match="schedule_ids_unique dt=2026-01-01"):
        medallion.build_silver_schedule(spark, lake)
    assert documents.read_table(spark, lake.silver("schedule")) is None


def test_drifting_shapes(spark, tmp_path):
    listed = '[{"broadcasterDisplay": "TV Sul"}]'
    shapes = [[{"broadcasterDisplay": "ESPN"}], ['{"broadcasterDisplay": "ESPN"}'], listed, [], None]
    games = [
        game(f"00225000{i:02d}", broadcasters={"nationalTvBroadcasters": shape, "intlTvBroadcasters": shape})
        for i, shape in enumerate(shapes)
    ]
    bare = {"gameId": "0022500099"}
    land(tmp_path / "2026-01-01/schedule_league_raw.json", schedule([(DAY, [*games, bare, {"gameStatus": 3}])]))
    docs = documents.read_documents(spark, str(tmp_path / "*" / "*.json"), schemas.SCHEDULE_DOCUMENT)
    silver = flatten.silver_schedule(docs)
    assert rows(silver, "game_id", "us_broadcaster") == [
        ("0022500000", "ESPN"), ("0022500001", "ESPN"), ("0022500002", "TV Sul"), ("0022500003", None),
        ("0022500004", None), ("0022500099", None),
    ]
    row = silver.filter("game_id = '0022500099'").first()
    assert (row.game_status, row.game_datetime_utc, row.game_type) == (None, None, "regular")


def test_played_flag_of_any_type(spark, tmp_path):
    document = boxscore("0022500001", home=(1, 2, 3, 4), away=(), idle=())
    for entry, flag in zip(document["game"]["homeTeam"]["players"], ["1", 1, True, "0"]):
        entry["played"] = flag
    land(tmp_path / "2026-01-01/boxscore_0022500001.json", document)
    docs = documents.read_documents(spark, str(tmp_path / "*" / "*.json"), schemas.BOXSCORE_DOCUMENT)
    assert rows(flatten.silver_player_stats(docs), "player_id") == [(1,), (2,), (3,)]


def test_boxscore_documents_are_scanned_once_for_both_sides(spark, lake):
    docs = documents.read_documents(spark, documents.date_folders(spark, lake.bronze("boxscores")), schemas.BOXSCORE_DOCUMENT)
    plan = flatten.silver_player_stats(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1


def test_incremental_boxscores_equal_batch(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    boxes, lines, progress = (str(tmp_path / n) for n in ("boxes", "lines", "progress"))
    for i in range(1, 5):
        land(landing / f"2026-01-01/boxscore_002250000{i}.json", boxscore(f"002250000{i}"))
        incremental.follow_boxscores(spark, str(landing), boxes, lines, progress)
    batch = documents.read_table(spark, lake.silver("boxscores"))
    assert rows(documents.read_table(spark, boxes), *batch.columns) == rows(batch, *batch.columns)
    players = documents.read_table(spark, lake.silver("player_stats"))
    stored = documents.read_table(spark, lines)
    assert rows(stored, *players.columns) == rows(players, *players.columns)
    assert rows(merge.players_dimension(stored), "player_id") == [(1,), (2,), (3,)]


def test_an_older_box_score_does_not_replace_a_newer_one(spark, tmp_path):
    landing = tmp_path / "landing"
    boxes, lines, progress = (str(tmp_path / n) for n in ("boxes", "lines", "progress"))
    for day, score in ((2, 120), (1, 90)):
        land(landing / f"2026-01-0{day}/boxscore_0022500001.json", boxscore("0022500001", home_score=score))
        incremental.follow_boxscores(spark, str(landing), boxes, lines, progress)
    assert rows(documents.read_table(spark, boxes), "home_score", "dt") == [(120, dt.date(2026, 1, 2))]


def test_replayed_and_late_schedules_change_nothing(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    newer = schedule([(DAY, [game("0022500001", 3)])])
    older = schedule([(DAY, [game("0022500001", 1), game("0022500002", 1)])])
    land(landing / "2026-01-02/s.json", newer)
    incremental.follow_schedule(spark, str(landing), table, str(tmp_path / "p1"))
    land(landing / "2026-01-01/s.json", older)
    incremental.follow_schedule(spark, str(landing), table, str(tmp_path / "p1"))
    expected = [("0022500001", 3, dt.date(2026, 1, 2)), ("0022500002", 1, dt.date(2026, 1, 1))]
    assert rows(documents.read_table(spark, table), "game_id", "game_status", "snapshot") == expected
    incremental.follow_schedule(spark, str(landing), table, str(tmp_path / "p2"))  # from scratch: a full replay
    assert rows(documents.read_table(spark, table), "game_id", "game_status", "snapshot") == expected


def test_digest_of_the_lake(spark, lake):
    gold = documents.read_table(spark, lake.gold("schedule")), documents.read_table(spark, lake.gold("boxscores"))
    lines = delivery.result_lines(*gold).collect()
    assert {r.local_date for r in lines} == {dt.date(2026, 1, 1)} and len(lines) == 4
    message = delivery.results_message(*gold, "Resultados", dt.date(2026, 1, 1)).collect()
    assert [(r.local_date, r.n_games) for r in message] == [(dt.date(2026, 1, 1), 4)]
    assert message[0].body.startswith("🏀 *Resultados — 2026-01-01*\n\n")
    assert message[0].body.endswith("Knicks *99*  x  *101* Celtics ✅") and message[0].body.count("\n\n") == 4
    assert delivery.results_message(*gold, "Resultados", dt.date(2026, 1, 2)).isEmpty()


def test_a_team_without_a_name_keeps_its_line(spark):
    games = spark.createDataFrame([("a", dt.datetime(2026, 1, 1, 20)), ("b", dt.datetime(2026, 1, 1, 21))], "game_id string, game_datetime_utc timestamp_ntz")
    boxes = spark.createDataFrame(
        [("a", True, None, "Home", 1, 2, "home"), ("b", True, "Away", None, 3, None, None)],
        "game_id string, is_final boolean, away_team_name string, home_team_name string, away_score int, home_score int, winner string",
    )
    body = delivery.results_message(games, boxes, "T", dt.date(2026, 1, 1)).first()
    assert body.n_games == 2 and body.body.split("\n\n")[1:] == ["- *1*  x  *2* Home ✅", "Away *3*  x  *-* -"]


def test_polls_of_the_lake(spark, lake):
    gold = documents.read_table(spark, lake.gold("schedule")).filter("poll_message_id is null")
    polls = delivery.due_polls(gold, day=dt.date(2026, 1, 1)).collect()
    assert {r.question for r in polls} == {"22h00"}
    assert {r.header for r in polls} == {"📅 *Jogos de Hoje — 01/01*"}
    assert all(r.game_id.startswith("002") for r in polls)


def test_closing_polls(spark):
    start = dt.datetime(2026, 1, 1, 20, 0)
    games = spark.createDataFrame(
        [("a", 5, start), ("b", None, start), ("c", 6, start + dt.timedelta(hours=1))],
        "game_id string, poll_message_id bigint, game_datetime_utc timestamp_ntz",
    )
    at = lambda minute: delivery.polls_to_close(games, dt.datetime(2026, 1, 1, 19, minute))
    assert rows(at(49), "game_id", "is_due", "minutes_left") == [("a", False, 1.0), ("c", False, 61.0)]
    assert rows(at(50), "game_id", "is_due", "minutes_left") == [("a", True, None), ("c", False, 60.0)]
    aware = dt.datetime(2026, 1, 1, 16, 50, tzinfo=dt.timezone(dt.timedelta(hours=-3)))
    assert rows(delivery.polls_to_close(games, aware).filter("is_due"), "game_id") == [("a",)]
    cleared = merge.patch_column(games, delivery.closed_poll_patch(at(50)), "game_id", "poll_message_id")
    assert rows(cleared, "game_id", "poll_message_id") == [("a", None), ("b", None), ("c", 6)]


def test_messages_go_out_once(spark, tmp_path):
    land_all(tmp_path)
    lake = medallion.Lake(str(tmp_path), min_games=1)
    medallion.refresh(spark, lake)
    day = dt.date(2026, 1, 1)
    assert messages.results_to_send(spark, lake, "Resultados", day=dt.date(2020, 1, 1)).isEmpty()
    assert [r.n_games for r in messages.results_to_send(spark, lake, "Resultados", day=day).collect()] == [4]
    assert messages.results_to_send(spark, lake, "Resultados", day=day).isEmpty()
    polls = messages.polls_to_send(spark, lake, day)
    assert [r.game_id for r in polls.collect()] == [f"002250000{i}" for i in range(1, 5)]
    assert messages.polls_to_send(spark, lake, day).isEmpty()
    sent = polls.select("game_id", F.lit(5).cast("bigint").alias("poll_message_id")).filter("game_id < '0022500003'")
    messages.record_polls(spark, lake, sent)
    assert messages.close_polls(spark, lake, dt.datetime(2026, 1, 2, 0, 49)).isEmpty()
    closed = messages.close_polls(spark, lake, dt.datetime(2026, 1, 2, 0, 50))
    assert rows(closed, "game_id", "poll_message_id") == [("0022500001", 5), ("0022500002", 5)]
    left = documents.read_table(spark, lake.gold("schedule"))
    assert left.filter("poll_message_id is not null").isEmpty() and left.count() == 6
