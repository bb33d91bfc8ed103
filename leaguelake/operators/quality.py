"""In-flight gates (stop or skip a write) and table contracts (violation counts)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from leaguelake.functions import derive

MAX_LOSS = 0.20  # fixed: largest share of games a schedule may lose on the way to Silver
MIN_SCORE = 60  # fixed: lowest plausible final score


class GateFailed(ValueError):
    """A gate with policy ``fail`` did not pass."""


@dataclass(frozen=True)
class Gate:
    """``passed`` is a boolean aggregate; ``policy`` says what a failure does: ``fail`` or ``skip``."""

    name: str
    passed: Column
    policy: str = "fail"


def not_empty(table: str, policy: str = "fail") -> Gate:
    return Gate(f"{table}_not_empty", F.count(F.lit(1)) > 0, policy)


def schedule_gates() -> list[Gate]:
    """For ``schedule_games`` rows carrying ``game_id`` before the null filter, so one scan sees both counts."""
    bronze, silver = F.count(F.lit(1)), F.count("game_id")
    return [
        Gate("schedule_not_empty", silver > 0),
        Gate("schedule_loss", F.when(bronze > 0, (bronze - silver) / bronze <= MAX_LOSS).otherwise(False)),
        Gate("schedule_ids_unique", F.countDistinct("game_id") == silver),
    ]


def boxscore_gates() -> list[Gate]:
    return [
        not_empty("boxscores"),
        Gate("boxscore_scores", F.count_if((F.col("away_score") < 0) | (F.col("home_score") < 0)) == 0),
    ]


def player_gates() -> list[Gate]:
    return [not_empty("player_lines", policy="skip")]


def gate_report(df: DataFrame, gates: list[Gate], by: Sequence[str] = ()) -> DataFrame:
    """(by..., gate, policy, passed) for every gate, from one aggregate over ``df``."""
    measured = df.groupBy(*by).agg(*[F.coalesce(g.passed, F.lit(False)).alias(g.name) for g in gates])
    rows = F.array(
        *[
            F.struct(F.lit(g.name).alias("gate"), F.lit(g.policy).alias("policy"), F.col(g.name).alias("passed"))
            for g in gates
        ]
    )
    return measured.select(*by, F.inline(rows))


def enforce(df: DataFrame, gates: list[Gate], by: Sequence[str] = ()) -> bool:
    """True when the write may go on, False when it is to be skipped; raises GateFailed otherwise.

    With ``by``, every group must pass; the error says for each gate how many groups fail and which is the first.
    """
    failed = gate_report(df, gates, by).filter(~F.col("passed"))
    first = F.min(F.struct(*by)) if by else F.lit(None)
    found = failed.groupBy("policy", "gate").agg(F.count(F.lit(1)).alias("n"), first.alias("first")).orderBy("gate").collect()
    stopping = [r for r in found if r["policy"] == "fail"]
    if stopping:
        where = lambda r: " ".join(f" {c}={r['first'][c]}" for c in by) + (f" and {r['n'] - 1} more" if r["n"] > 1 else "")
        raise GateFailed("; ".join(r["gate"] + where(r) for r in stopping))
    return not found


def _typed(raw: Column, typed: Column) -> Column:
    """Number of present values that could not be typed."""
    return F.count_if(raw.isNotNull() & (raw != "") & typed.isNull())


def snapshot_gates(min_games: int) -> list[Gate]:
    """For games (``one`` marks a game) and, where a snapshot has none, a row without one, so an empty snapshot is seen."""
    bronze, silver = F.count("one"), F.count("game_id")
    return [
        Gate("schedule_not_empty", silver > 0),
        Gate("schedule_complete", silver >= min_games),
        Gate("schedule_loss", F.when(bronze > 0, (bronze - silver) / bronze <= MAX_LOSS).otherwise(False)),
        Gate("schedule_ids_unique", F.countDistinct("game_id") == silver),
    ]


def landed_schedule_gates(min_games: int) -> list[Gate]:
    """All gates of landed schedules, for the rows of ``snapshot_gates`` with ``game`` and ``_corrupt_record``."""
    return [*document_gates(), *snapshot_gates(min_games), *schedule_value_gates()]


def landed_boxscore_gates() -> list[Gate]:
    """All gates of landed box scores, for documents with their Silver columns and ``_corrupt_record``."""
    negative = (F.col("away_score") < 0) | (F.col("home_score") < 0)
    landed = [Gate("boxscores_not_empty", F.count("game_id") > 0), Gate("boxscore_scores", F.count_if(negative) == 0)]
    return [*document_gates(), *boxscore_value_gates(), *landed]


def document_gates() -> list[Gate]:
    """For documents held with their ``_corrupt_record``."""
    return [Gate("documents_readable", F.count("_corrupt_record") == 0)]


def schedule_value_gates() -> list[Gate]:
    """For ``schedule_games`` rows."""
    status, start = F.col("game.gameStatus"), F.col("game.gameDateTimeUTC")
    return [
        Gate("schedule_status_typed", _typed(status, derive.as_int(status)) == 0),
        Gate("schedule_start_typed", _typed(start, derive.utc_instant(start)) == 0),
    ]


def boxscore_value_gates() -> list[Gate]:
    """For box score documents."""
    whole = [F.col("game.gameStatus"), F.col("game.homeTeam.score"), F.col("game.awayTeam.score")]
    return [Gate("boxscore_numbers_typed", sum((_typed(c, derive.as_int(c)) for c in whole), F.lit(0)) == 0)]


# contract name -> kind
CONTRACTS = {
    "boxscore_game_in_schedule": "referential",
    "player_stats_game_in_schedule": "referential",
    "player_stats_player_in_dim": "referential",
    "final_game_has_boxscore": "completeness",
    "final_game_has_player_stats": "completeness",
    "game_has_two_sides": "cardinality",
    "scores_not_negative": "row",
    "final_scores_plausible": "joined row",
    "winner_domain": "domain",
    "game_type_domain": "domain",
    "side_domain": "domain",
    "percentages_in_range": "range",
    "points_not_negative": "range",
    "winner_matches_score": "cross-column",
    "player_stats_key_unique": "key",
    "made_within_attempted": "cross-column",
}


def _out_of_range(name: str) -> Column:
    return (F.col(name) < 0) | (F.col(name) > 1)


def contract_suite(
    schedule: DataFrame, boxscores: DataFrame, player_stats: DataFrame, players: DataFrame
) -> DataFrame:
    """(check_name, kind, violations) for all sixteen contracts of the star schema.

    Player lines are reduced to one row per game, and per game and player, before anything is joined, so a game
    or player holding a large share of the lines costs one row per task. The per-game checks then share one
    co-partitioned pass over schedule, box scores and that reduction.
    """
    per_game = _per_game(schedule, boxscores, player_stats)
    game_counts = per_game.agg(*[F.sum(n).alias(name) for name, n in _game_checks().items()])
    pairs = player_stats.groupBy("game_id", "player_id").agg(F.count(F.lit(1)).alias("n"))
    key_counts = pairs.agg(F.count_if(F.col("n") > 1).alias("player_stats_key_unique"))
    unknown = pairs.join(players.select("player_id"), "player_id", "left_anti").agg(
        F.sum("n").alias("player_stats_player_in_dim")
    )
    return (
        _as_rows(game_counts).unionByName(_as_rows(key_counts)).unionByName(_as_rows(unknown))
    )


def game_violations(
    schedule: DataFrame, boxscores: DataFrame, player_stats: DataFrame, players: DataFrame
) -> DataFrame:
    """(game_id, one count per contract) for every game that any of the tables names; their sums are ``contract_suite``.

    Every contract judges rows of one game, so the counts of a game change only with its own rows or, for
    ``player_stats_player_in_dim``, with the players. Rows without a game id share a row.
    """
    per_game = _per_game(schedule, boxscores, player_stats).select("game_id", *[n.alias(name) for name, n in _game_checks().items()])
    known = players.select("player_id", F.lit(True).alias("in_players")).distinct()
    pairs = player_stats.groupBy("game_id", "player_id").agg(F.count(F.lit(1)).alias("n")).join(known, "player_id", "left")
    per_line = pairs.select(
        "game_id",
        F.when(F.col("n") > 1, 1).otherwise(0).alias("player_stats_key_unique"),
        F.when(F.col("in_players").isNull(), F.col("n")).otherwise(0).alias("player_stats_player_in_dim"),
    )
    counted = per_game.unionByName(per_line, allowMissingColumns=True)
    return counted.groupBy("game_id").agg(*[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in CONTRACTS])


def summed(counts: DataFrame) -> DataFrame:
    """(check_name, kind, violations) from rows of counts, as ``contract_suite`` gives them."""
    return _as_rows(counts.agg(*[F.sum(name).alias(name) for name in CONTRACTS]))


def _per_game(schedule: DataFrame, boxscores: DataFrame, player_stats: DataFrame) -> DataFrame:
    """Schedule, box score and reduced player lines of each game side by side."""
    line_checks = {
        "side_domain": ~F.col("side").isin("home", "away"),
        "percentages_in_range": _out_of_range("fg_pct") | _out_of_range("tp_pct") | _out_of_range("ft_pct"),
        "points_not_negative": F.col("pts") < 0,
        "made_within_attempted": (F.col("fgm") > F.col("fga"))
        | (F.col("tpm") > F.col("tpa"))
        | (F.col("ftm") > F.col("fta")),
    }
    lines = player_stats.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.countDistinct("side").alias("n_sides"),
        *[F.count_if(test).alias(name) for name, test in line_checks.items()],
    )
    return (
        schedule.select("game_id", "game_type", "game_status", F.lit(True).alias("in_schedule"))
        .join(
            boxscores.select(
                "game_id", "is_final", "home_score", "away_score", "winner", F.lit(True).alias("in_boxscores")
            ),
            "game_id",
            "full",
        )
        .join(lines, "game_id", "full")
    )


def _game_checks() -> dict[str, Column]:
    """Contract -> violations in a row of ``_per_game``."""
    col = F.col
    unscheduled = col("in_schedule").isNull()
    boxed, unboxed = col("in_boxscores").isNotNull(), col("in_boxscores").isNull()
    low = (col("home_score") < MIN_SCORE) | (col("away_score") < MIN_SCORE)
    tests = {
        "boxscore_game_in_schedule": boxed & unscheduled,
        "final_game_has_boxscore": (col("game_status") == derive.FINAL_STATUS) & unboxed,
        "final_game_has_player_stats": col("is_final") & col("n_lines").isNull(),
        "game_has_two_sides": col("n_sides") != 2,
        "scores_not_negative": (col("home_score") < 0) | (col("away_score") < 0),
        "final_scores_plausible": col("is_final") & col("game_type").isin("regular", "playoff", "play-in") & low,
        "winner_domain": ~col("winner").isin("home", "away"),
        "game_type_domain": ~col("game_type").isin(*derive.GAME_TYPES),
        "winner_matches_score": col("is_final")
        & (
            ((col("home_score") > col("away_score")) & (col("winner") != "home"))
            | ((col("away_score") > col("home_score")) & (col("winner") != "away"))
        ),
    }
    of_lines = ("side_domain", "percentages_in_range", "points_not_negative", "made_within_attempted")
    return {
        **{name: F.when(test, 1).otherwise(0) for name, test in tests.items()},
        "player_stats_game_in_schedule": F.when(unscheduled, col("n_lines")),
        **{name: col(name) for name in of_lines},
    }


def _as_rows(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check_name"),
                        F.lit(CONTRACTS[name]).alias("kind"),
                        F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias("violations"),
                    )
                    for name in counts.columns
                ]
            )
        )
    )


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are repeated or incomplete: (keys..., n_rows)."""
    incomplete = F.lit(False)
    for key in keys:
        incomplete = incomplete | F.col(key).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
        .filter((F.col("n_rows") > 1) | incomplete)
    )
