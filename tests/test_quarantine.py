"""Broken files among good ones in the streaming way: the good are stored, the broken reported, corrected ones taken in."""

import datetime as dt
import os

import pytest
from league_files import boxscore, game, land, schedule

from leaguelake.sources.documents import read_table
from leaguelake.streaming import incremental

DAY = "01/01/2026 00:00:00"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def touch_later(path, seconds=60):
    now = os.stat(path).st_mtime + seconds
    os.utime(path, (now, now))


def reported(spark, table):
    return [(path.rsplit("/", 1)[1], reason, n) for path, reason, n in rows(incremental.dead_letters(spark, table), "path", "reason", "documents")]


def test_box_scores(spark, tmp_path):
    landing = tmp_path / "landing"
    boxes, lines, progress = (str(tmp_path / n) for n in ("boxes", "lines", "progress"))
    letters = f"{boxes}_dead_letters"
    follow = lambda: incremental.follow_boxscores(spark, str(landing), boxes, lines, progress)
    day = landing / "2026-01-01"
    land(day / "boxscore_0022500001.json", boxscore("0022500001"))
    write(day / "boxscore_0022500002.json", '{"game": {"gameId": "0022500002", "homeTe')
    land(day / "boxscore_0022500003.json", {"game": {"gameStatus": 3}})
    land(day / "boxscore_0022500004.json", boxscore("0022500004", home_score=-4, status="late"))
    write(day / "boxscore_0022500005.json", "<html>busy</html>")
    follow()
    assert rows(read_table(spark, boxes), "game_id") == [("0022500001",)] and read_table(spark, lines).count() == 3
    broken = [
        ("boxscore_0022500002.json", "unreadable", 1), ("boxscore_0022500003.json", "no_game_id", 1),
        ("boxscore_0022500004.json", "number_untyped", 1), ("boxscore_0022500004.json", "score_negative", 1),
        ("boxscore_0022500005.json", "unreadable", 1),
    ]
    assert reported(spark, letters) == broken
    assert rows(incremental.dead_letters(spark, letters).select("dt").distinct(), "dt") == [(dt.date(2026, 1, 1),)]
    # nothing new: nothing changes; a later drop is not blocked
    land(landing / "2026-01-02/boxscore_0022500006.json", boxscore("0022500006"))
    follow()
    assert rows(read_table(spark, boxes), "game_id") == [("0022500001",), ("0022500006",)] and reported(spark, letters) == broken
    # one file is corrected, one is changed and still broken
    land(day / "boxscore_0022500002.json", boxscore("0022500002", home_score=88))
    write(day / "boxscore_0022500003.json", "[1")
    land(day / "boxscore_0022500005.json", boxscore("0022500005"))
    for name in ("2", "3", "5"):
        touch_later(day / f"boxscore_002250000{name}.json")
    follow()
    assert rows(read_table(spark, boxes), "game_id", "home_score") == [
        ("0022500001", 101), ("0022500002", 88), ("0022500005", 101), ("0022500006", 101)
    ]
    assert [r[:2] for r in reported(spark, letters)] == [
        ("boxscore_0022500003.json", "unreadable"), ("boxscore_0022500004.json", "number_untyped"), ("boxscore_0022500004.json", "score_negative")
    ]


@pytest.mark.parametrize(
    "content, reason",
    [
        ('{"leagueSchedule": {"gameDates": [{"gam', "unreadable"),
        ({"other": 1}, "no_schedule"),
        (schedule([(DAY, [game("0022500002"), game("0022500002")])]), "ids_repeated"),
        (schedule([(DAY, [game("0022500002"), game(None)])]), "ids_lost"),
        (schedule([(DAY, [game("0022500002", "soon")])]), "status_untyped"),
        (schedule([(DAY, [game("0022500002", when="TBD")])]), "start_untyped"),
        (schedule([]), "too_few_games"),
    ],
)
def test_schedules(spark, tmp_path, content, reason):
    landing, table, progress = tmp_path / "landing", str(tmp_path / "schedule"), str(tmp_path / "progress")
    land(landing / "2026-01-01/s.json", schedule([(DAY, [game("0022500001")])]))
    bad = landing / "2026-01-02/s.json"
    write(bad, content) if isinstance(content, str) else land(bad, content)
    follow = lambda: incremental.follow_schedule(spark, str(landing), table, progress, min_games=1)
    follow()
    assert rows(read_table(spark, table), "game_id", "snapshot") == [("0022500001", dt.date(2026, 1, 1))]
    assert [r[1] for r in reported(spark, f"{table}_dead_letters")] == [reason]
    if reason == "unreadable":
        land(bad, schedule([(DAY, [game("0022500001", 1), game("0022500002")])]))
        touch_later(bad)
        follow()
        assert rows(read_table(spark, table), "game_id", "game_status") == [("0022500001", 1), ("0022500002", 3)]
        assert reported(spark, f"{table}_dead_letters") == []


def test_lines_of_one_file(spark, tmp_path):
    """One document to a line: the sound lines of a file are stored."""
    import json

    landing, progress = tmp_path / "landing", str(tmp_path / "progress")
    boxes, lines = str(tmp_path / "boxes"), str(tmp_path / "lines")
    good = [json.dumps(boxscore(f"002250000{i}")) for i in range(1, 5)]
    write(landing / "2026-01-01/all.json", "\n".join([good[0], good[1][:70], good[2], "{}", good[3][:-30]]))
    incremental.follow_boxscores(spark, str(landing), boxes, lines, progress, multi_line=False)
    assert rows(read_table(spark, boxes), "game_id") == [("0022500001",), ("0022500003",)]
    assert reported(spark, f"{boxes}_dead_letters") == [("all.json", "no_game_id", 1), ("all.json", "unreadable", 2)]


def test_nothing_landed_yet(spark, tmp_path):
    (tmp_path / "landing/2026-01-01").mkdir(parents=True)
    table = str(tmp_path / "schedule")
    incremental.follow_schedule(spark, str(tmp_path / "landing"), table, str(tmp_path / "progress"))
    assert incremental.dead_letters(spark, f"{table}_dead_letters").isEmpty()
