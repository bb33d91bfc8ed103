"""Contract violations kept up to date: a stored row of counts per game, counted again only for games that changed.

The ledger and the tables of games lie in the same hash blocks of ``game_id``, so an update lists, reads and rewrites
the blocks of the changed games alone. The report is a sum over the ledger, one narrow row per game, whatever the
number of player lines.

Changed games are noted before the tables are written and forgotten when the ledger has them: after a run that was
lost in between, the next one counts them too.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from leaguelake import schemas
from leaguelake.operators import partitions, quality
from leaguelake.operators.merge import empty_table
from leaguelake.session import held_at, release

GAME_TABLES = ("schedule", "boxscores", "player_stats")


def _part(schema: StructType, *names: str) -> StructType:
    return StructType([schema[name] for name in names])


# what the contracts read
COLUMNS = {
    "schedule": _part(schemas.SILVER_SCHEDULE, "game_id", "game_type", "game_status"),
    "boxscores": _part(schemas.SILVER_BOXSCORES, "game_id", "is_final", "home_score", "away_score", "winner"),
    "player_stats": _part(
        schemas.SILVER_PLAYER_STATS, "game_id", "player_id", "side", "pts", "fgm", "fga", "tpm", "tpa", "ftm", "fta", *schemas.PERCENTAGES
    ),
    "players": _part(schemas.SILVER_PLAYER_STATS, "player_id"),
}
GAME = _part(schemas.SILVER_SCHEDULE, "game_id")
LEDGER = StructType([*GAME.fields, *[StructField(name, LongType()) for name in quality.CONTRACTS]])


def note(changed: DataFrame, path: str) -> None:
    """Add games (``game_id``) to those whose counts are out of date. Rows without id have none to keep."""
    changed.select("game_id").filter("game_id IS NOT NULL").distinct().write.mode("append").parquet(path)


def noted(spark: SparkSession, path: str) -> DataFrame | None:
    return partitions.read(spark, path, GAME)


def changed_schedule(snapshots: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Games whose listed type or status is not the stored one; a daily snapshot lists all games and changes few."""
    judged = ["game_id", "game_type", "game_status"]
    if stored is None:
        return snapshots.select("game_id")
    listed, held = snapshots.select(*judged).distinct().alias("l"), stored.select(*judged).alias("s")
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in judged[1:]])
    return listed.join(held, (F.col("l.game_id") == F.col("s.game_id")) & same, "left_anti").select("game_id")


def recount(spark: SparkSession, games: DataFrame, tables: Mapping[str, str]) -> DataFrame:
    """(game_id, one count per contract) of the given games, zeros where nothing is wrong or nothing is stored.

    ``tables``: paths of ``schedule``, ``boxscores``, ``player_stats`` (in blocks of ``game_id``) and ``players``.
    """
    touched = partitions.touched_blocks(games, "game_id")

    def of_games(kind: str) -> DataFrame:
        rows = partitions.in_blocks(spark, tables[kind], touched, COLUMNS[kind])
        return empty_table(spark, COLUMNS[kind]) if rows is None else rows.join(games, "game_id", "left_semi")

    players = partitions.read(spark, tables["players"], COLUMNS["players"])
    if players is None:
        players = empty_table(spark, COLUMNS["players"])
    counts = quality.game_violations(*[of_games(kind) for kind in GAME_TABLES], players)
    zeros = [F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in quality.CONTRACTS]
    return games.join(counts, "game_id", "left").select("game_id", *zeros)


def all_games(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Every game that a stored table names."""
    stored = [partitions.read(spark, tables[t], COLUMNS[t]) for t in GAME_TABLES]
    named = [empty_table(spark, GAME), *[rows.select("game_id") for rows in stored if rows is not None]]
    return reduce(DataFrame.unionByName, named).distinct()


def update(spark: SparkSession, path: str, changed: DataFrame, tables: Mapping[str, str]) -> None:
    """Count the changed games again. Games with lines of unknown players are always among them, since a player that
    came may have been theirs; players never go."""
    ids = changed.select("game_id")
    stored = partitions.read(spark, path, LEDGER)
    if stored is not None:
        ids = ids.unionByName(stored.filter("player_stats_player_in_dim > 0").select("game_id"))
    games, place = held_at(ids.filter("game_id IS NOT NULL").distinct(), "changed")
    partitions.merge(spark, path, recount(spark, games, tables), "game_id", None)
    release(spark, place)


def report(spark: SparkSession, path: str) -> DataFrame:
    """(check_name, kind, violations) of all contracts, as ``quality.contract_suite`` over the whole tables."""
    stored = partitions.read(spark, path, LEDGER)
    return quality.summed(empty_table(spark, LEDGER) if stored is None else stored)


def offenders(spark: SparkSession, path: str) -> DataFrame:
    """(game_id, check_name, violations) of the games that break a contract."""
    stored = partitions.read(spark, path, LEDGER)
    rows = empty_table(spark, LEDGER) if stored is None else stored
    counts = [F.struct(F.lit(name).alias("check_name"), F.col(name).alias("violations")) for name in quality.CONTRACTS]
    return rows.select("game_id", F.inline(F.array(*counts))).filter("violations > 0")
