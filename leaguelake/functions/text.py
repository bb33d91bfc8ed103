"""Message text as column expressions. The wording is fixed by the messages users receive."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed wording
POLL_HEADER = "📅 *Jogos de Hoje — %s*"
RESULT_HEADER = "🏀 *%s — %s*"
WINNER_MARK = " ✅"
LINE_BREAK = "\n\n"


def poll_header(day: Column) -> Column:
    return F.format_string(POLL_HEADER, F.date_format(day, "dd/MM"))


def poll_question(local: Column, broadcaster: Column) -> Column:
    named = F.length(F.coalesce(broadcaster, F.lit(""))) > 0
    return F.concat(
        F.format_string("%02dh%02d", F.hour(local), F.minute(local)),
        F.when(named, F.concat(F.lit(" — "), broadcaster)).otherwise(""),
    )


def poll_options(kind: Column, home_wins: Column, away_wins: Column) -> tuple[Column, Column]:
    """(away option, home option); a playoff game with a known standing shows the score after that win."""
    away = F.concat_ws(" ", "away_team_city", "away_team_name")
    home = F.concat_ws(" ", "home_team_city", "home_team_name")
    known = (kind == "playoff") & home_wins.isNotNull()
    return (
        F.when(known, F.concat(away, F.lit(" "), away_wins + 1, F.lit("x"), home_wins)).otherwise(away),
        F.when(known, F.concat(home, F.lit(" "), home_wins + 1, F.lit("x"), away_wins)).otherwise(home),
    )


def result_line(winner: Column) -> Column:
    def mark(side: str) -> Column:
        return F.when(winner == side, WINNER_MARK).otherwise("")

    def score(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("-"))

    def team(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("-"))

    return F.concat(
        team("away_team_name"), mark("away"), F.lit(" *"), score("away_score"), F.lit("*  x  *"),
        score("home_score"), F.lit("* "), team("home_team_name"), mark("home"),
    )


def result_header(title: str, day: Column) -> Column:
    return F.format_string(RESULT_HEADER, F.lit(title), day.cast("string"))
