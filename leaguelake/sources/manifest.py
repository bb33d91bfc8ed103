"""What is wanted, what has landed, and what is still to do, as joins over whole tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from leaguelake.functions import derive, localtime
from leaguelake.operators.flatten import schedule_games

MIN_GAMES = 100  # fixed: a schedule source with fewer games counts as truncated


def games_in_document() -> Column:
    """Number of games listed in a schedule document."""
    return F.aggregate(
        "leagueSchedule.gameDates",
        F.lit(0).cast("bigint"),
        lambda total, day: total + F.coalesce(F.size(day["games"]), F.lit(0)),
    )


def source_report(candidates: DataFrame, min_games: int = MIN_GAMES) -> DataFrame:
    """(source, priority, total_games, accepted, chosen): the best-ranked source with enough games is chosen.

    ``candidates`` holds (source, priority, leagueSchedule); a source may span many documents.
    """
    totals = candidates.groupBy("source", "priority").agg(
        F.sum(games_in_document()).cast("bigint").alias("total_games")
    )
    ranked = totals.withColumn("accepted", F.coalesce(F.col("total_games") >= min_games, F.lit(False)))
    # one row per source here, so this window is as small as the list of sources
    place = F.row_number().over(Window.partitionBy("accepted").orderBy("priority", "source"))
    return ranked.withColumn("chosen", F.col("accepted") & (place == 1))


def choose_source(candidates: DataFrame, min_games: int = MIN_GAMES) -> DataFrame:
    """Documents of the chosen source; raises when no source has enough games."""
    chosen = source_report(candidates, min_games).filter("chosen").select("source").limit(1).collect()
    if not chosen:
        raise RuntimeError("no schedule source holds enough games")
    return candidates.filter(F.col("source") == chosen[0]["source"])


def wanted_games(schedule: DataFrame) -> DataFrame:
    """(dt, game_id) of every listed game. Of days a document lists twice, the first counts; days whose label
    is not a date are left out."""
    listed = schedule.select(
        F.col("leagueSchedule.gameDates").alias("entries"),
        F.transform("leagueSchedule.gameDates", lambda day: derive.calendar_day(day["gameDate"])).alias("dates"),
    )
    first_listed = F.filter(
        F.arrays_zip("dates", "entries"),
        lambda pair, place: F.array_position(F.col("dates"), pair["dates"]) == place + 1,
    )
    days = listed.select(F.explode(first_listed).alias("day"))
    return days.select(F.col("day.dates").alias("dt"), F.explode("day.entries.games").alias("game")).select(
        "dt", F.col("game.gameId").alias("game_id")
    )


def completed_games(schedule: DataFrame) -> DataFrame:
    """(dt, game_id) of finished games with an id, on days whose label is a date."""
    return (
        schedule_games(schedule)
        .select(
            derive.calendar_day(F.col("game_date")).alias("dt"),
            F.col("game.gameId").alias("game_id"),
            derive.as_int(F.col("game.gameStatus")).alias("game_status"),
        )
        .filter((F.col("game_status") == derive.FINAL_STATUS) & (F.col("game_id") != "") & F.col("dt").isNotNull())
        .select("dt", "game_id")
    )


def missing_games(wanted: DataFrame, landed: DataFrame) -> DataFrame:
    """Wanted games without a landed document. Completeness goes by game, not by date folder."""
    return wanted.join(landed.select("game_id"), "game_id", "left_anti").select("dt", "game_id")


def pending_dates(bronze: DataFrame, boxscores: DataFrame, player_stats: DataFrame) -> DataFrame:
    """(dt, need_boxscores, need_players) for landed dates that a Silver table lacks."""
    flags = ("landed", "boxscores", "players")
    seen = [
        table.select("dt", *[F.lit(flag == own).alias(flag) for flag in flags])
        for own, table in zip(flags, (bronze, boxscores, player_stats))
    ]
    return (
        reduce(DataFrame.unionByName, seen)
        .groupBy("dt")
        .agg(*[F.max(flag).alias(flag) for flag in flags])
        .filter(F.col("landed") & ~(F.col("boxscores") & F.col("players")))
        .select("dt", (~F.col("boxscores")).alias("need_boxscores"), (~F.col("players")).alias("need_players"))
    )


def ingest_audit(wanted: DataFrame, landed: DataFrame, run_start: dt.datetime) -> DataFrame:
    """(dt, wanted, landed, skipped, failed, none_landed) per date and, with NULL ``dt``, in total.

    ``landed`` holds one row per game with ``landed_at``; games already there when the run began are skipped,
    games that came since are landed, the others failed.
    """
    start = localtime.utc_literal(run_start)
    at = F.col("landed_at")
    return (
        wanted.join(landed.select("game_id", "landed_at"), "game_id", "left")
        .rollup("dt")
        .agg(
            F.count(F.lit(1)).alias("wanted"),
            F.count_if(at >= start).alias("landed"),
            F.count_if(at < start).alias("skipped"),
            F.count_if(at.isNull()).alias("failed"),
        )
        .withColumn("none_landed", (F.col("wanted") > 0) & (F.col("landed") + F.col("skipped") == 0))
    )


def require_landed(audit: DataFrame) -> None:
    """Raise when games of some date were wanted and none of them landed."""
    dates = audit.filter(F.col("none_landed") & F.col("dt").isNotNull())
    found = dates.agg(F.count(F.lit(1)).alias("n"), F.min("dt").alias("first"), F.max("dt").alias("last")).first()
    if found["n"]:
        raise ValueError(f"no box score landed for {found['n']} dates from {found['first']} to {found['last']}")
