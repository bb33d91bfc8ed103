"""Nested documents to typed Silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leaguelake import schemas
from leaguelake.functions import derive


def schedule_games(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per game of every day of every document: (carry..., game_date, game)."""
    days = documents.select(*carry, F.explode("leagueSchedule.gameDates").alias("day"))
    return days.select(
        *carry, F.col("day.gameDate").alias("game_date"), F.explode("day.games").alias("game")
    )


def project_schedule(games: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Typed game columns plus the helper columns the derivations need; rows without an id are dropped."""
    return games.select(
        *carry,
        F.col("game.gameId").alias("game_id"),
        derive.utc_instant(F.col("game.gameDateTimeUTC")).alias("game_datetime_utc"),
        derive.as_int(F.col("game.gameStatus")).alias("game_status"),
        F.col("game.homeTeam.teamCity").alias("home_team_city"),
        F.col("game.homeTeam.teamName").alias("home_team_name"),
        F.col("game.awayTeam.teamCity").alias("away_team_city"),
        F.col("game.awayTeam.teamName").alias("away_team_name"),
        derive.first_broadcaster(F.col("game.broadcasters.nationalTvBroadcasters")).alias("us_broadcaster"),
        derive.first_broadcaster(F.col("game.broadcasters.intlTvBroadcasters")).alias("brazil_broadcaster"),
        F.col("game.seriesText").alias("series_text"),
        F.col("game.gameCode").alias("game_code"),
    ).filter(F.col("game_id").isNotNull())


def derive_schedule(projected: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Game type and series standing, then the fixed Silver layout (helpers dropped)."""
    typed = projected.withColumn("game_type", derive.game_type(F.col("game_id")))
    return derive.with_series_wins(
        typed,
        F.when(F.col("game_type") == "playoff", F.col("series_text")),
        derive.home_code(F.col("game_code")),
        derive.away_code(F.col("game_code")),
    ).select(*carry, *schemas.SILVER_SCHEDULE.fieldNames())


def silver_schedule(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return derive_schedule(project_schedule(schedule_games(documents, carry), carry), carry)


def derive_boxscore(projected: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return projected.withColumns(
        {
            "is_final": derive.is_final(F.col("game_status")),
            "winner": derive.winner(F.col("away_score"), F.col("home_score")),
        }
    ).select(*carry, *schemas.SILVER_BOXSCORES.fieldNames())


def silver_boxscores(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    projected = documents.select(
        *carry,
        F.col("game.gameId").alias("game_id"),
        derive.as_int(F.col("game.gameStatus")).alias("game_status"),
        F.col("game.awayTeam.teamCity").alias("away_team_city"),
        F.col("game.awayTeam.teamName").alias("away_team_name"),
        derive.as_int(F.col("game.awayTeam.score")).alias("away_score"),
        F.col("game.homeTeam.teamCity").alias("home_team_city"),
        F.col("game.homeTeam.teamName").alias("home_team_name"),
        derive.as_int(F.col("game.homeTeam.score")).alias("home_score"),
    )
    return derive_boxscore(projected, carry)


def player_entries(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per listed player of either side, from a single pass over the documents."""

    def side(name: str, team: str) -> Column:
        column = F.col(f"game.{team}")
        fields = {"team_id": "teamId", "team_city": "teamCity", "team_name": "teamName", "players": "players"}
        return F.struct(F.lit(name).alias("side"), *[column[field].alias(alias) for alias, field in fields.items()])

    # the list is a column of its own, so it is not carried beside each of its players
    sides = documents.select(
        *carry, F.col("game.gameId").alias("game_id"), F.inline(F.array(side("home", "homeTeam"), side("away", "awayTeam")))
    )
    return sides.select(*carry, "game_id", "side", "team_id", "team_city", "team_name", F.explode("players").alias("player"))


def silver_player_stats(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Lines of players who played, in the fixed Silver layout."""

    typed = {}
    for name, field in schemas.STATISTIC_FIELDS.items():
        raw = F.col(f"player.statistics.{field}")
        if name == "minutes":
            typed[name] = raw
        elif name in schemas.PERCENTAGES:
            typed[name] = raw.try_cast("double")
        else:
            typed[name] = derive.as_int(raw)
    played = player_entries(documents, carry).filter(F.col("player.played").isin("1", "true"))
    return played.select(
        *carry,
        "game_id",
        F.col("team_id").try_cast("bigint").alias("team_id"),
        "team_city",
        "team_name",
        "side",
        F.col("player.personId").try_cast("bigint").alias("player_id"),
        F.col("player.name").alias("player_name"),
        F.col("player.position").alias("position"),
        derive.as_int(F.col("player.starter")).alias("starter"),
        *[column.alias(name) for name, column in typed.items()],
    )
