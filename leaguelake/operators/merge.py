"""Idempotent table maintenance as frames: keyed merges, patches, reservations. ``tables`` stores the results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import AtomicType, StructType

from leaguelake import schemas
from leaguelake.functions import derive

CLINCHING_WINS = 4  # fixed: wins that end a series


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``. Spark limits each key to one row per task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _total_order(df: DataFrame, *but: str) -> list[Column]:
    """Columns that tell any two different rows apart, so that a choice among rows never depends on their order."""
    return [F.col(f.name).asc_nulls_first() for f in df.schema.fields if isinstance(f.dataType, AtomicType) and f.name not in but]


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Newest row per key: the effect of replaying every snapshot in date order, in one pass. Of several rows of one
    version the least by all their columns is taken."""
    return keep_first(df, keys, [F.desc(version), *_total_order(df, *keys, version)])


def players_dimension(player_stats: DataFrame) -> DataFrame:
    """One row per player with the date it comes from: newest date, home line before away line, then game id."""
    columns = ["player_id", "player_name", "position", "dt"]
    order = [
        F.desc("dt"), F.desc("side"), F.col("game_id"),
        F.col("player_name").asc_nulls_first(), F.col("position").asc_nulls_first(),
    ]
    return keep_first(player_stats.select(*columns, "side", "game_id"), ["player_id"], order).select(*columns)


def player_facts(player_stats: DataFrame) -> DataFrame:
    """One line per (game, player) with surrogate key ``pk`` and a boolean ``starter``; newest date first."""
    facts = player_stats.drop("player_name", "position").withColumns(
        {
            "starter": derive.truthy(F.col("starter")),
            "pk": derive.surrogate_key(F.col("game_id"), F.col("player_id")),
        }
    )
    teams = ("team_id", "team_city", "team_name")
    statistics = [c for c in ("starter", *schemas.STATISTIC_FIELDS, *teams) if c in facts.columns]
    order = [F.desc("dt"), F.desc("side"), *[F.col(c).asc_nulls_first() for c in statistics]]
    return keep_first(facts, ["player_id", "game_id"], order)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def add_missing(df: DataFrame, columns: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add absent columns with their default; present columns stay as they are."""
    return df.withColumns(
        {
            name: F.lit(default).cast(kind)
            for name, (kind, default) in columns.items()
            if name not in df.columns
        }
    )


def upsert(
    target: DataFrame, batch: DataFrame, key: str, update: Sequence[str], version: str | None = None
) -> DataFrame:
    """Target after inserting new keys and overwriting ``update`` columns of known ones.

    The batch holds one row per key. Target columns outside ``update`` survive on known keys; a new key takes
    them from the batch when it has them and is NULL otherwise (see ``add_missing`` for defaults). With
    ``version``, a batch row older than the stored one changes nothing, so batches may arrive in any order.
    """
    t, b = target.alias("t"), batch.withColumn("_in_batch", F.lit(True)).alias("b")
    joined = t.join(b, F.col(f"t.{key}") == F.col(f"b.{key}"), "full")
    in_batch, known = F.col("b._in_batch").isNotNull(), F.col(f"t.{key}").isNotNull()

    if version is not None:
        in_batch &= ~known | F.coalesce(F.col(f"b.{version}") >= F.col(f"t.{version}"), F.lit(True))

    def merged(name: str) -> Column:
        if name == key:
            return F.coalesce(F.col(f"t.{key}"), F.col(f"b.{key}")).alias(key)
        if name not in batch.columns:
            return F.col(f"t.{name}").alias(name)
        take = in_batch if name in update else in_batch & ~known
        return F.when(take, F.col(f"b.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    return joined.select(*[merged(name) for name in target.columns])


def cancel_phantoms(schedule: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Schedule with ``is_cancelled`` worked out anew from the current snapshot, plus ``newly_cancelled``.

    An unfinished playoff game is cancelled when it is gone from the snapshot or in a series that is already won, and
    not cancelled otherwise, whatever its flag was: a game that is listed again comes back. Any other listed game
    is not cancelled; one that is not listed keeps its flag. NULL status or NULL wins never cancel.
    """
    current = snapshot.select("game_id").distinct().withColumn("_listed", F.lit(True))
    listed = F.col("_listed").isNotNull()
    open_playoff = F.coalesce((F.col("game_type") == "playoff") & (F.col("game_status") != derive.FINAL_STATUS), F.lit(False))
    clinched = (F.col("home_series_wins") >= CLINCHING_WINS) | (F.col("away_series_wins") >= CLINCHING_WINS)
    flag = (
        F.when(open_playoff, ~listed | F.coalesce(clinched, F.lit(False)))
        .when(listed, F.lit(False))
        .otherwise(F.coalesce("is_cancelled", F.lit(False)))
    )
    return (
        schedule.join(current, "game_id", "left")
        .withColumn("_flag", flag)
        .withColumn("newly_cancelled", F.col("_flag") & ~F.coalesce("is_cancelled", F.lit(False)))
        .withColumn("is_cancelled", F.col("_flag"))
        .drop("_listed", "_flag")
    )


def patch_column(target: DataFrame, patches: DataFrame, key: str, column: str) -> DataFrame:
    """Set ``column`` on the patched keys; a NULL patch value clears it. Of several patches for a key the greatest counts."""
    patch = patches.groupBy(key).agg(F.max(column).alias("_value"), F.lit(True).alias("_patched"))
    return (
        target.join(patch, key, "left")
        .withColumn(column, F.when(F.col("_patched"), F.col("_value")).otherwise(F.col(column)))
        .select(*target.columns)
    )


def reserve_once(candidates: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates not yet in the ledger, one row per key."""
    sent = ledger.select(*keys).distinct()
    return candidates.select(*keys).distinct().join(sent, list(keys), "left_anti")


def assert_schema(df: DataFrame, schema: StructType) -> None:
    found = [(f.name, f.dataType) for f in df.schema.fields]
    expected = [(f.name, f.dataType) for f in schema.fields]
    if found != expected:
        raise ValueError(f"schema differs: expected {expected}, found {found}")
