"""Every refresh stores which wanted games got a box score; a date that got none is reported, or fails the run on request."""

import datetime as dt

import pytest
from league_files import boxscore, game, land, schedule

from leaguelake.plans import medallion

DAY = "01/01/2026 00:00:00"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def planted(root):
    games = [game("0022500001", when="2026-01-01T20:00:00Z"), game("0022500002", when="2026-01-01T22:00:00Z"), game("0022500003", when="2026-01-02T20:00:00Z")]
    land(root / "bronze/schedule/2026-01-03/s.json", schedule([(DAY, [*games, game("0022500004", 1, when="2026-01-05T20:00:00Z")])]))
    land(root / "bronze/boxscores/2026-01-01/boxscore_0022500001.json", boxscore("0022500001"))
    return medallion.Lake(str(root), min_games=1)


def test_dates_without_any_box_score(spark, tmp_path):
    lake = planted(tmp_path)
    assert medallion.none_landed(spark, lake).isEmpty()
    medallion.refresh(spark, lake)
    columns = ("dt", "wanted", "landed", "skipped", "failed")
    assert rows(medallion.none_landed(spark, lake), *columns) == [(dt.date(2026, 1, 2), 1, 0, 0, 1)]
    with pytest.raises(ValueError, match="no box score landed for 1 dates from 2026-01-02"):
        medallion.refresh(spark, lake, require_landed=True)
    medallion.refresh(spark, lake, since=dt.date(2026, 1, 3), require_landed=True)
    land(tmp_path / "bronze/boxscores/2026-01-02/boxscore_0022500003.json", boxscore("0022500003"))
    report = medallion.refresh(spark, lake, require_landed=True)
    assert medallion.none_landed(spark, lake).isEmpty()
    assert {r["violations"] for r in report.filter("check_name = 'final_game_has_boxscore'").collect()} == {1}


def test_without_a_schedule(spark, tmp_path):
    lake = medallion.Lake(str(tmp_path))
    medallion.record_audit(spark, lake, dt.datetime(2026, 1, 1))
    assert medallion.none_landed(spark, lake).isEmpty()
    with pytest.raises(FileNotFoundError):
        medallion.ingest_report(spark, lake, dt.datetime(2026, 1, 1))
