"""The gates of a landed table are one pass over it, and every failing gate is named at once."""

import pytest
from league_files import boxscore, game, land, schedule

from leaguelake.operators import quality
from leaguelake.plans import medallion

DAY = "01/01/2026 00:00:00"


@pytest.fixture
def passes(monkeypatch):
    """Gate names of each pass by date."""
    seen, enforce = [], quality.enforce

    def counted(df, gates, by=()):
        if by:
            seen.append([g.name for g in gates])
        return enforce(df, gates, by)

    monkeypatch.setattr(quality, "enforce", counted)
    return seen


def test_schedule(spark, tmp_path, passes):
    bronze = tmp_path / "bronze/schedule"
    land(bronze / "2026-01-01/s.json", schedule([(DAY, [game("0022500001"), game(None), None, game("0022500002", "soon")])]))
    land(bronze / "2026-01-02/s.json", schedule([(DAY, []), (DAY, [game("0022500001")])]))
    (bronze / "2026-01-03").mkdir()
    (bronze / "2026-01-03/s.json").write_text("{")
    lake = medallion.Lake(str(tmp_path), min_games=1)
    with pytest.raises(quality.GateFailed) as error:
        medallion.build_silver_schedule(spark, lake)
    assert str(error.value) == (
        "documents_readable dt=2026-01-03; schedule_complete dt=2026-01-03; schedule_loss dt=2026-01-01 and 1 more; "
        "schedule_not_empty dt=2026-01-03; schedule_status_typed dt=2026-01-01"
    )
    assert len(passes) == 1 and len(set(passes[0])) == 7


def test_box_scores(spark, tmp_path, passes):
    bronze = tmp_path / "bronze/boxscores"
    land(bronze / "2026-01-01/boxscore_1.json", boxscore("0022500001", home_score=-1))
    land(bronze / "2026-01-02/boxscore_2.json", {"game": {"gameStatus": "late"}})
    land(bronze / "2026-01-03/boxscore_3.json", boxscore("0022500003"))
    with pytest.raises(quality.GateFailed) as error:
        medallion.build_silver_games(spark, medallion.Lake(str(tmp_path)))
    assert str(error.value) == "boxscore_numbers_typed dt=2026-01-02; boxscore_scores dt=2026-01-01; boxscores_not_empty dt=2026-01-02"
    assert len(passes) == 1 and len(set(passes[0])) == 4
