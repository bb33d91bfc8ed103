"""Small landed documents in the feed's shapes, written one document per file."""

import json
from pathlib import Path


def team(name, city="City", **more):
    return {"teamName": name, "teamCity": city, **more}


def game(game_id, status=3, code="20260101/NYKBOS", when="2026-01-02T01:00:00Z", series="", **more):
    body = {
        "gameId": game_id, "gameStatus": status, "gameDateTimeUTC": when, "gameCode": code, "seriesText": series,
        "homeTeam": team("Celtics", "Boston"), "awayTeam": team("Knicks", "New York"),
        "broadcasters": {
            "nationalTvBroadcasters": [{"broadcasterDisplay": "ESPN", "id": 1}],
            "intlTvBroadcasters": [],
        },
    }
    body.update(more)
    return body


def schedule(days):
    return {
        "leagueSchedule": {
            "seasonYear": "2025-26",
            "gameDates": [{"gameDate": label, "games": games} for label, games in days],
        }
    }


def player(person, played="1", pts=10, **statistics):
    stats = {
        "minutes": "PT20M00.00S", "points": pts, "reboundsTotal": 3, "assists": 2, "steals": 1, "blocks": 0,
        "turnovers": 1, "plusMinusPoints": 4.0, "fieldGoalsMade": 4, "fieldGoalsAttempted": 9,
        "fieldGoalsPercentage": 0.444, "threePointersMade": 1, "threePointersAttempted": 3,
        "threePointersPercentage": 0.333, "freeThrowsMade": 1, "freeThrowsAttempted": 2, "freeThrowsPercentage": 0.5,
        "reboundsOffensive": 1, "reboundsDefensive": 2,
    }
    stats.update(statistics)
    entry = {
        "personId": person, "name": f"Player {person}", "position": "G", "starter": "1", "played": played,
        "statistics": stats,
    }
    if played == "0":
        entry.update(notPlayingReason="INACTIVE", notPlayingDescription="rest")
    return entry


def boxscore(game_id, home_score=101, away_score=99, status=3, home=(1, 2), away=(3,), idle=(9,)):
    side = lambda ids: [player(i) for i in ids] + [player(i, played="0") for i in idle]
    return {
        "meta": {"version": 1},
        "game": {
            "gameId": game_id, "gameStatus": status, "arena": {"name": "x"},
            "homeTeam": team("Celtics", "Boston", teamId=10, score=home_score, players=side(home)),
            "awayTeam": team("Knicks", "New York", teamId=20, score=away_score, players=side(away)),
        },
    }


def land(path, document):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(document, indent=4, ensure_ascii=False), encoding="utf-8")
