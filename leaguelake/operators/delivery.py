"""Message content: result digests, due polls, closing polls, and the once-per-date outbox."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from leaguelake.functions import localtime, text

CLOSE_BEFORE_MINUTES = 10  # fixed: polls close this long before the game


def final_results(
    schedule: DataFrame, boxscores: DataFrame, zone: str = localtime.LOCAL_ZONE, day: dt.date | None = None
) -> DataFrame:
    """Finished games with their local date; ``day`` limits the schedule before the join."""
    games = schedule.select("game_id", "game_datetime_utc")
    if day is not None:
        games = games.filter(localtime.on_local_date(F.col("game_datetime_utc"), day, zone))
    finals = boxscores.filter("is_final").select(
        "game_id", "away_team_name", "home_team_name", "away_score", "home_score", "winner"
    )
    return games.join(finals, "game_id").withColumn(
        "local_date", localtime.local_date(F.col("game_datetime_utc"), zone)
    )


def result_lines(
    schedule: DataFrame, boxscores: DataFrame, zone: str = localtime.LOCAL_ZONE, day: dt.date | None = None
) -> DataFrame:
    """(local_date, game_datetime_utc, game_id, line): the digest lines of all local dates (or of one), one row each."""
    results = final_results(schedule, boxscores, zone, day)
    return results.select("local_date", "game_datetime_utc", "game_id", text.result_line(F.col("winner")).alias("line"))


def results_message(
    schedule: DataFrame, boxscores: DataFrame, title: str, day: dt.date, zone: str = localtime.LOCAL_ZONE
) -> DataFrame:
    """(local_date, n_games, body): the message of one local date, its lines in time order; no row without results."""
    lines = F.array_sort(F.collect_list(F.struct("game_datetime_utc", "game_id", "line")))
    body = F.concat_ws(
        text.LINE_BREAK,
        text.result_header(title, F.col("local_date")),
        F.array_join(F.transform("lines", lambda entry: entry["line"]), text.LINE_BREAK),
    )
    return (
        result_lines(schedule, boxscores, zone, day)
        .groupBy("local_date")
        .agg(F.count(F.lit(1)).alias("n_games"), lines.alias("lines"))
        .select("local_date", "n_games", body.alias("body"))
    )


def due_polls(schedule: DataFrame, zone: str = localtime.LOCAL_ZONE, day: dt.date | None = None) -> DataFrame:
    """Polls still to open: header, question and two options per game that has no poll and is not cancelled."""
    games = schedule.filter(F.col("poll_message_id").isNull() & (F.col("is_cancelled") == F.lit(False)))
    if day is not None:
        games = games.filter(localtime.on_local_date(F.col("game_datetime_utc"), day, zone))
    local = localtime.local_time(F.col("game_datetime_utc"), zone)
    away, home = text.poll_options(F.col("game_type"), F.col("home_series_wins"), F.col("away_series_wins"))
    return (
        games.withColumn("local_date", F.to_date(local))
        .select(
            "local_date",
            "game_datetime_utc",
            "game_id",
            text.poll_header(F.col("local_date")).alias("header"),
            text.poll_question(local, F.col("brazil_broadcaster")).alias("question"),
            F.array(away, home).alias("options"),
        )
        .orderBy("game_datetime_utc", "game_id")
    )


def polls_to_close(schedule: DataFrame, now: dt.datetime) -> DataFrame:
    """(game_id, poll_message_id, close_at, is_due, minutes_left) of every open poll at the UTC time ``now``."""
    moment = localtime.utc_literal(now)
    close_at = F.col("game_datetime_utc") - F.make_dt_interval(mins=F.lit(CLOSE_BEFORE_MINUTES))
    return (
        schedule.filter(F.col("poll_message_id").isNotNull())
        .withColumn("close_at", close_at)
        .select(
            "game_id",
            "poll_message_id",
            "close_at",
            (moment >= F.col("close_at")).alias("is_due"),
            F.when(
                moment < F.col("close_at"), localtime.seconds_between(moment, F.col("close_at")) / 60
            ).alias("minutes_left"),
        )
    )


def closed_poll_patch(closing: DataFrame) -> DataFrame:
    """Patch that clears the poll id of every poll that is due."""
    return closing.filter("is_due").select("game_id", F.lit(None).cast("bigint").alias("poll_message_id"))
