"""Landed JSON to Silver to Gold, over all pending dates at once. Every step may be run again safely."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from leaguelake import schemas
from leaguelake.functions import derive, localtime
from leaguelake.operators import flatten, ledger, merge, partitions, quality
from leaguelake.session import held_at, release
from leaguelake.sources import documents, drift, manifest


@dataclass(frozen=True)
class Lake:
    """Where the landed files and the tables lie. ``multi_line`` False: one document per line. ``min_games``: a
    schedule snapshot with fewer games counts as truncated."""

    root: str
    multi_line: bool = True
    min_games: int = manifest.MIN_GAMES

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def bronze(self, kind: str) -> str:
        return self.path("bronze", kind)

    def silver(self, table: str) -> str:
        return self.path("silver", table)

    def gold(self, table: str) -> str:
        return self.path("gold", table)


def landed(spark: SparkSession, lake: Lake, kind: str, since: dt.date | None = None) -> DataFrame:
    """(path, dt, landed_at) of the files in the date folders from ``since`` on."""
    folders = documents.date_folders(spark, lake.bronze(kind), since)
    if not folders:
        return merge.empty_table(spark, schemas.INGESTED)
    return documents.landed_files(spark, folders)


def pending(spark: SparkSession, lake: Lake, kind: str, since: dt.date | None = None) -> DataFrame:
    """Landed files that Silver has not taken in, or that have changed since."""
    files = landed(spark, lake, kind, since)
    taken = partitions.read(spark, lake.silver(f"{kind}_ingested"), schemas.INGESTED)
    return files if taken is None else files.join(taken, ["path", "landed_at"], "left_anti")


def _record(spark: SparkSession, lake: Lake, kind: str, files: DataFrame) -> None:
    partitions.replace(files.select(*schemas.INGESTED.fieldNames()), lake.silver(f"{kind}_ingested"))


def _documents(spark: SparkSession, lake: Lake, kind: str, schema, since: dt.date | None):
    """Documents of all dates with new or changed files, those files, and where both are held; None if there are none.

    A date is read whole, so a late file joins the others of its date. Each file is parsed once.
    """
    # at most one row per calendar day
    days = [r["dt"] for r in pending(spark, lake, kind, since).select("dt").distinct().orderBy("dt").collect() if r["dt"]]
    if not days:
        return None
    folders = [f"{lake.bronze(kind)}/{day}" for day in days]
    files, files_at = held_at(documents.landed_files(spark, folders), "files")
    rows, rows_at = held_at(documents.read_documents(spark, folders, schema, lake.multi_line), "documents")
    return rows, files, (files_at, rows_at)


def build_silver_schedule(spark: SparkSession, lake: Lake, since: dt.date | None = None) -> None:
    """New or changed schedule snapshots, one block per snapshot date, gated by date before anything is written."""
    found = _documents(spark, lake, "schedule", schemas.SCHEDULE_DOCUMENT, since)
    if found is None:
        return
    rows, files, held = found
    # a snapshot without any game keeps a row of its own here, so every date is judged, in one pass
    opened = rows.select("dt", documents.BROKEN, F.explode_outer("leagueSchedule.gameDates").alias("day"))
    listed = opened.select("dt", documents.BROKEN, F.posexplode_outer("day.games").alias("one", "game")).withColumn("game_id", F.col("game.gameId"))
    quality.enforce(listed, quality.landed_schedule_gates(lake.min_games), by=["dt"])
    silver = flatten.silver_schedule(rows, ["dt"])
    merge.assert_schema(silver.drop("dt"), schemas.SILVER_SCHEDULE)
    partitions.replace(silver, lake.silver("schedule"))
    _record(spark, lake, "schedule", files)
    release(spark, *held)


def build_silver_games(spark: SparkSession, lake: Lake, since: dt.date | None = None) -> None:
    """Box scores and player lines of the dates with new or changed files."""
    found = _documents(spark, lake, "boxscores", schemas.BOXSCORE_DOCUMENT, since)
    if found is None:
        return
    rows, files, held = found
    boxes = flatten.silver_boxscores(rows, ["dt"])
    judged = flatten.silver_boxscores(rows, ["dt", documents.BROKEN, "game"])
    quality.enforce(judged, quality.landed_boxscore_gates(), by=["dt"])
    merge.assert_schema(boxes.drop("dt"), schemas.SILVER_BOXSCORES)
    players = flatten.silver_player_stats(rows, ["dt"])
    merge.assert_schema(players.drop("dt"), schemas.SILVER_PLAYER_STATS)
    if quality.enforce(players.limit(1), quality.player_gates()):  # one line is enough to pass
        partitions.replace(players, lake.silver("player_stats"))
    partitions.replace(boxes, lake.silver("boxscores"))
    _record(spark, lake, "boxscores", files)
    release(spark, *held)


def _wanted(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """(dt, game_id) of the finished games of the newest schedule, None if there is no schedule."""
    stored = partitions.read(spark, lake.silver("schedule"))
    if stored is None:
        return None
    finished = newest_date(stored).filter(F.col("game_status") == derive.FINAL_STATUS)
    return finished.select(F.to_date("game_datetime_utc").alias("dt"), "game_id")


def _audit(spark: SparkSession, lake: Lake, wanted: DataFrame, run_start: dt.datetime, since: dt.date | None = None) -> DataFrame:
    """Audit of wanted games against the box scores landed from ``since`` on, from the listing alone."""
    files = landed(spark, lake, "boxscores", since).select(
        documents.path_game_id(F.col("path")).alias("game_id"), F.to_utc_timestamp("landed_at", "UTC").cast("timestamp_ntz").alias("landed_at")
    )
    return manifest.ingest_audit(wanted, files.groupBy("game_id").agg(F.max("landed_at").alias("landed_at")), run_start)


def ingest_report(spark: SparkSession, lake: Lake, run_start: dt.datetime) -> DataFrame:
    """Audit of the newest schedule's finished games against all landed box scores; raises when a date got none."""
    wanted = _wanted(spark, lake)
    if wanted is None:
        raise FileNotFoundError("no schedule found")
    audit = _audit(spark, lake, wanted, run_start)
    manifest.require_landed(audit)
    return audit


def record_audit(spark: SparkSession, lake: Lake, run_start: dt.datetime, since: dt.date | None = None) -> None:
    """Store the audit of a run, one row per date of finished games; ``since`` leaves earlier dates as they are."""
    wanted = _wanted(spark, lake)
    if wanted is None:
        return
    listed_from = None
    if since is not None:
        wanted = wanted.filter(F.col("dt") >= F.lit(since))
        listed_from = since - dt.timedelta(days=1)  # a game's UTC date may be the day after its folder's
    audit = _audit(spark, lake, wanted, run_start, listed_from).filter(F.col("dt").isNotNull())
    partitions.replace(audit.withColumn("run_start", localtime.utc_literal(run_start)), lake.path("audit"))


def none_landed(spark: SparkSession, lake: Lake) -> DataFrame:
    """Dates of the stored audit whose games were wanted and got no box score, with the columns of the audit."""
    stored = partitions.read(spark, lake.path("audit"))
    return merge.empty_table(spark, schemas.AUDIT) if stored is None else stored.filter("none_landed").select(*schemas.AUDIT.fieldNames())


def drift_report(spark: SparkSession, lake: Lake, kind: str, since: dt.date | None = None) -> DataFrame:
    """What landed documents hold beyond their read schema, or in another shape; see ``sources.drift``."""
    folders = documents.date_folders(spark, lake.bronze(kind), since)
    schema = {"schedule": schemas.SCHEDULE_DOCUMENT, "boxscores": schemas.BOXSCORE_DOCUMENT}[kind]
    if not folders:
        return drift.drift(merge.empty_table(spark, schemas.RAW), schema)
    return drift.landed_drift(spark, folders, schema, lake.multi_line, schemas.ANY_SHAPE)


def newest_date(stored: DataFrame) -> DataFrame:
    """Rows of the greatest partition ``dt``: a literal date, so the other partitions are not read."""
    newest = stored.agg(F.max("dt")).first()[0]
    return stored.filter(F.col("dt") == F.lit(newest))


def load_gold(spark: SparkSession, lake: Lake, since: dt.date | None = None) -> None:
    """Merge Silver into the star schema; the newest date of a key wins.

    Without ``since`` all dates are replayed. With it only the Silver dates from then on are read, and rows older than
    the stored ones change nothing. Cancellations always follow the newest snapshot of all.
    """

    def silver(table: str) -> DataFrame | None:
        stored = partitions.read(spark, lake.silver(table))
        return stored if stored is None or since is None else stored.filter(F.col("dt") >= F.lit(since))

    schedule, boxes, lines = silver("schedule"), silver("boxscores"), silver("player_stats")
    changed = [rows.select("game_id") for rows in (boxes, lines) if rows is not None]
    if schedule is not None:
        changed.append(ledger.changed_schedule(schedule, partitions.read(spark, lake.gold("schedule"))))
    if changed:
        ledger.note(reduce(DataFrame.unionByName, changed), lake.path("contracts", "changed"))
    if schedule is not None:
        load_schedule(spark, lake.gold("schedule"), schedule.withColumnRenamed("dt", "snapshot"))
        cancel(spark, lake.gold("schedule"), newest_date(partitions.read(spark, lake.silver("schedule"))))
    if boxes is not None:
        partitions.merge(spark, lake.gold("boxscores"), merge.latest_per_key(boxes, ["game_id"], "dt"), "game_id", version="dt")
    if lines is not None:
        partitions.merge(spark, lake.gold("players"), merge.players_dimension(lines), "player_id", version="dt")
        partitions.merge(spark, lake.gold("player_stats"), merge.player_facts(lines), "pk", version="dt", block_key="game_id")


def load_schedule(spark: SparkSession, path: str, snapshots: DataFrame) -> None:
    """Merge schedule snapshots (Silver columns and ``snapshot``) into the Gold schedule; operational columns stay."""
    newest = merge.latest_per_key(snapshots, ["game_id"], "snapshot")
    columns = [*schemas.SILVER_SCHEDULE.fieldNames(), "snapshot"]
    update = [c for c in columns if c != "game_id"]
    partitions.merge(spark, path, newest.select(*columns), "game_id", "snapshot", update, schemas.GOLD_SCHEDULE_EXTRAS)


def cancel(spark: SparkSession, path: str, snapshot: DataFrame) -> None:
    """Work the cancellations of the Gold schedule out anew from one snapshot; without rows in it nothing changes."""
    if snapshot.isEmpty():
        return
    flags = merge.cancel_phantoms(partitions.read(spark, path).withColumn("_was", F.col("is_cancelled")), snapshot)
    changed = flags.filter(~F.col("_was").eqNullSafe(F.col("is_cancelled"))).select("game_id", "is_cancelled")
    partitions.merge(spark, path, changed, "game_id", None, ["is_cancelled"])


def check_gold(spark: SparkSession, lake: Lake, whole: bool = False) -> DataFrame:
    """Violation counts of every contract over the stored star schema.

    Only games that ``load_gold`` touched since the last check are counted again; the others' counts are stored by game
    (``ledger.offenders`` names those that break a contract). ``whole`` counts all games again, for tables changed by other means.
    """
    tables = {t: lake.gold(t) for t in (*ledger.GAME_TABLES, "players")}
    counts, notes = lake.path("contracts", "games"), lake.path("contracts", "changed")
    first = partitions.read(spark, counts) is None
    changed = ledger.all_games(spark, tables) if whole or first else ledger.noted(spark, notes)
    if changed is not None:
        ledger.update(spark, counts, changed, tables)
        release(spark, notes)
    return ledger.report(spark, counts)


def refresh(spark: SparkSession, lake: Lake, since: dt.date | None = None, require_landed: bool = False) -> DataFrame:
    """The whole way for whatever has landed; returns the contract report. ``since`` limits all steps to dates from
    then on.

    The audit of wanted against landed games is stored with every run (``none_landed`` reads it). With ``require_landed`` a date
    of finished games without any box score fails the run, after all that did land is stored.
    """
    run_start = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    build_silver_schedule(spark, lake, since)
    build_silver_games(spark, lake, since)
    load_gold(spark, lake, since)
    record_audit(spark, lake, run_start, since)
    if require_landed:
        missing = none_landed(spark, lake)
        manifest.require_landed(missing if since is None else missing.filter(F.col("dt") >= F.lit(since)))
    return check_gold(spark, lake)
