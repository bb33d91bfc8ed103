"""Explicit read schemas (Bronze) and table layouts (Silver, Gold).

Bronze leaves are declared as text: the feed changes a field between number, text, list and object from file
to file, and text keeps whatever arrives. The projections in ``operators.flatten`` type every leaf.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT = T.StringType()
INT = T.IntegerType()
BIGINT = T.LongType()
DOUBLE = T.DoubleType()
BOOLEAN = T.BooleanType()
DATE = T.DateType()
INSTANT = T.TimestampNTZType()  # UTC, without zone

_SCHEDULE_TEAM = _struct(teamName=TEXT, teamCity=TEXT)
_SCHEDULE_GAME = _struct(
    gameId=TEXT,
    gameDateTimeUTC=TEXT,
    gameStatus=TEXT,
    gameCode=TEXT,
    seriesText=TEXT,
    homeTeam=_SCHEDULE_TEAM,
    awayTeam=_SCHEDULE_TEAM,
    broadcasters=_struct(nationalTvBroadcasters=TEXT, intlTvBroadcasters=TEXT),
)
SCHEDULE_DOCUMENT = _struct(
    leagueSchedule=_struct(
        gameDates=T.ArrayType(_struct(gameDate=TEXT, games=T.ArrayType(_SCHEDULE_GAME)))
    )
)

# text leaves that the feed fills with texts, objects or lists, all of which the projections read
ANY_SHAPE = (
    "leagueSchedule.gameDates[].games[].broadcasters.nationalTvBroadcasters",
    "leagueSchedule.gameDates[].games[].broadcasters.intlTvBroadcasters",
)

# output column -> field of the player's statistics object (fixed by the feed)
STATISTIC_FIELDS = {
    "minutes": "minutes",
    "pts": "points",
    "reb": "reboundsTotal",
    "ast": "assists",
    "stl": "steals",
    "blk": "blocks",
    "tov": "turnovers",
    "plus_minus": "plusMinusPoints",
    "fgm": "fieldGoalsMade",
    "fga": "fieldGoalsAttempted",
    "fg_pct": "fieldGoalsPercentage",
    "tpm": "threePointersMade",
    "tpa": "threePointersAttempted",
    "tp_pct": "threePointersPercentage",
    "ftm": "freeThrowsMade",
    "fta": "freeThrowsAttempted",
    "ft_pct": "freeThrowsPercentage",
    "reb_off": "reboundsOffensive",
    "reb_def": "reboundsDefensive",
}
PERCENTAGES = ("fg_pct", "tp_pct", "ft_pct")

_PLAYER = _struct(
    personId=TEXT,
    name=TEXT,
    position=TEXT,
    starter=TEXT,
    played=TEXT,
    statistics=_struct(**{field: TEXT for field in STATISTIC_FIELDS.values()}),
)
_BOX_TEAM = _struct(teamId=TEXT, teamCity=TEXT, teamName=TEXT, score=TEXT, players=T.ArrayType(_PLAYER))
BOXSCORE_DOCUMENT = _struct(
    game=_struct(gameId=TEXT, gameStatus=TEXT, homeTeam=_BOX_TEAM, awayTeam=_BOX_TEAM)
)

_BOX_HEADER_TEAM = _struct(teamCity=TEXT, teamName=TEXT, score=TEXT)
# the box score without its player lists: JSON has no nested pruning, a narrow schema does it by hand
BOXSCORE_HEADER = _struct(
    game=_struct(gameId=TEXT, gameStatus=TEXT, homeTeam=_BOX_HEADER_TEAM, awayTeam=_BOX_HEADER_TEAM)
)

SILVER_SCHEDULE = _struct(
    game_id=TEXT, game_datetime_utc=INSTANT, game_status=INT, game_type=TEXT, home_team_city=TEXT,
    home_team_name=TEXT, away_team_city=TEXT, away_team_name=TEXT, us_broadcaster=TEXT, brazil_broadcaster=TEXT,
    home_series_wins=INT, away_series_wins=INT,
)
SILVER_BOXSCORES = _struct(
    game_id=TEXT, game_status=INT, away_team_city=TEXT, away_team_name=TEXT, away_score=INT,
    home_team_city=TEXT, home_team_name=TEXT, home_score=INT, is_final=BOOLEAN, winner=TEXT,
)
SILVER_PLAYER_STATS = _struct(
    game_id=TEXT, team_id=BIGINT, team_city=TEXT, team_name=TEXT, side=TEXT, player_id=BIGINT, player_name=TEXT,
    position=TEXT, starter=INT, minutes=TEXT, pts=INT, reb=INT, ast=INT, stl=INT, blk=INT, tov=INT,
    plus_minus=INT, fgm=INT, fga=INT, fg_pct=DOUBLE, tpm=INT, tpa=INT, tp_pct=DOUBLE, ftm=INT, fta=INT,
    ft_pct=DOUBLE, reb_off=INT, reb_def=INT,
)

# operational columns the Gold schedule carries on top of Silver: name -> (type, default)
GOLD_SCHEDULE_EXTRAS = {
    "poll_message_id": ("bigint", None),
    "is_cancelled": ("boolean", False),
}
INGESTED = T.StructType([T.StructField("path", T.StringType()), T.StructField("dt", T.DateType()), T.StructField("landed_at", T.TimestampType())])
GOLD_LEDGER = _struct(sent_date=DATE, channel=TEXT)
AUDIT = _struct(dt=DATE, wanted=BIGINT, landed=BIGINT, skipped=BIGINT, failed=BIGINT, none_landed=BOOLEAN, run_start=INSTANT)
RAW = _struct(doc=TEXT)
