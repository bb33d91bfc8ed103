"""Questions the star schema answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leaguelake.functions import derive
from leaguelake.operators.ordered import over_preceding

FORM_GAMES = 5
FREE_THROW_WEIGHT = 0.44  # fixed: share of free throws that end a possession


def _ratio(top: str, bottom: str) -> Column:
    return F.when(F.sum(bottom) != 0, F.sum(top) / F.sum(bottom))


def leaders(player_facts: DataFrame, players: DataFrame, top: int = 10) -> DataFrame:
    """(stat, place, player_id, player_name, total): players in the best ``top`` totals, ties included.

    The rank filter becomes a per-task limit before the shuffle, so a stat never gathers all players.
    """
    totals = player_facts.groupBy("player_id").agg(
        F.sum("pts").alias("points"), F.sum("reb").alias("rebounds"), F.sum("ast").alias("assists")
    )
    long = totals.unpivot(["player_id"], ["points", "rebounds", "assists"], "stat", "total")
    place = F.dense_rank().over(Window.partitionBy("stat").orderBy(F.desc("total")))
    best = long.withColumn("place", place).filter(F.col("place") <= top)
    return best.join(players.select("player_id", "player_name"), "player_id", "left").select(
        "stat", "place", "player_id", "player_name", "total"
    )


def player_form(player_facts: DataFrame, schedule: DataFrame, games: int = FORM_GAMES) -> DataFrame:
    """Points per game with the average of the last ``games`` games and the change since the game before."""
    lines = player_facts.select("player_id", "game_id", "pts").join(
        schedule.select("game_id", "game_datetime_utc"), "game_id"
    )
    columns = {
        "avg_pts": lambda w: F.avg("pts").over(w.rowsBetween(-(games - 1), 0)),
        "delta_pts": lambda w: F.col("pts") - F.lag("pts").over(w),
    }
    order = [F.col("game_datetime_utc"), F.col("game_id")]
    return over_preceding(lines, ["player_id"], order, columns, reach=games - 1).select(
        "player_id", "game_id", "game_datetime_utc", "pts", *columns
    )


def team_efficiency(player_facts: DataFrame) -> DataFrame:
    """Shooting and possession rates per team, as ratios of sums."""
    return player_facts.groupBy("team_id", "team_city", "team_name").agg(
        F.sum("pts").alias("pts"),
        _ratio("fgm", "fga").alias("fg_rate"),
        _ratio("tpm", "tpa").alias("tp_rate"),
        _ratio("ftm", "fta").alias("ft_rate"),
        _ratio("ast", "tov").alias("ast_per_tov"),
    )


def position_distribution(player_facts: DataFrame, players: DataFrame) -> DataFrame:
    """Lines, minutes and points per position, with exact quartiles of points.

    Lines are counted per (player, points, minutes) before the dimension is joined, and per (position, points,
    minutes) after it: the quartiles read a small histogram, even when one position holds most lines.
    """
    per_player = (
        player_facts.withColumn("mins", derive.minutes_played(F.col("minutes")))
        .groupBy("player_id", "pts", "mins")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    histogram = (
        per_player.join(players.select("player_id", "position"), "player_id")
        .groupBy("position", "pts", "mins")
        .agg(F.sum("n").alias("n"))
    )

    def quartile(p: float) -> Column:
        return F.percentile("pts", F.lit(p), F.col("n"))

    def present(name: str) -> Column:
        return F.sum(F.when(F.col(name).isNotNull(), F.col("n")))

    def weighted(name: str) -> Column:
        return F.sum(F.col(name) * F.col("n")) / present(name)

    return histogram.groupBy("position").agg(
        F.sum("n").alias("n_lines"),
        F.coalesce(present("mins"), F.lit(0)).alias("n_timed"),
        weighted("mins").alias("avg_minutes"),
        weighted("pts").alias("avg_pts"),
        quartile(0.25).alias("pts_q1"),
        quartile(0.5).alias("pts_median"),
        quartile(0.75).alias("pts_q3"),
    )


def plus_minus_context(player_facts: DataFrame, schedule: DataFrame, boxscores: DataFrame) -> DataFrame:
    """Plus/minus per player: overall and by side, by game type and by outcome (``context``, ``value``)."""
    lines = (
        player_facts.select("player_id", "game_id", "side", "plus_minus")
        .join(schedule.select("game_id", "game_type"), "game_id")
        .join(boxscores.select("game_id", "winner"), "game_id", "left")
    )
    outcome = (
        F.when(F.col("winner") == F.col("side"), "win")
        .when(F.col("winner").isin("home", "away"), "loss")
        .otherwise("undecided")
    )
    cells = (
        lines.withColumn("outcome", outcome)
        .groupBy("player_id", "side", "game_type", "outcome")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("plus_minus").alias("pm"))
    )
    player, side, kind, result = (F.col(c) for c in ("player_id", "side", "game_type", "outcome"))
    level = F.grouping_id()
    return (
        cells.groupingSets(
            [[player], [player, side], [player, kind], [player, result]],
            player, side, kind, result,
        )
        .agg(F.sum("n").alias("games"), F.sum("pm").alias("plus_minus"), level.alias("_level"))
        .select(
            "player_id",
            F.when(F.col("_level") == 3, "side").when(F.col("_level") == 5, "game_type")
            .when(F.col("_level") == 6, "outcome").otherwise("all").alias("context"),
            F.coalesce("side", "game_type", "outcome", F.lit("all")).alias("value"),
            "games",
            "plus_minus",
        )
    )


def advanced_metrics(player_facts: DataFrame) -> DataFrame:
    """True shooting and usage share per player.

    Usage is the share of team possessions a player used while on the floor, over the games in which the
    player's minutes are known. Team totals come from one aggregate per (game, side).
    """
    used = F.col("fga") + FREE_THROW_WEIGHT * F.col("fta") + F.col("tov")
    minutes = derive.minutes_played(F.col("minutes"))
    lines = player_facts.select(
        "player_id", "game_id", "side", "pts", "fga", "fta", "tov", minutes.alias("mins")
    )
    team = lines.groupBy("game_id", "side").agg(
        F.sum("fga").alias("team_fga"),
        F.sum("fta").alias("team_fta"),
        F.sum("tov").alias("team_tov"),
        F.sum("mins").alias("team_mins"),
    )
    totals = (
        lines.filter(F.col("mins").isNotNull())
        .join(team, ["game_id", "side"])
        .groupBy("player_id")
        .agg(*[F.sum(c).alias(c) for c in (
            "pts", "fga", "fta", "tov", "mins", "team_fga", "team_fta", "team_tov", "team_mins"
        )])
    )
    shots = F.col("fga") + FREE_THROW_WEIGHT * F.col("fta")
    team_used = F.col("team_fga") + FREE_THROW_WEIGHT * F.col("team_fta") + F.col("team_tov")
    return totals.select(
        "player_id",
        F.col("mins").alias("minutes"),
        F.when(shots > 0, F.col("pts") / (2 * shots)).alias("true_shooting"),
        F.when(
            (F.col("mins") > 0) & (team_used > 0),
            100 * used * (F.col("team_mins") / 5) / (F.col("mins") * team_used),
        ).alias("usage"),
    )
