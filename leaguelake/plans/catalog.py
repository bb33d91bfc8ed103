"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from leaguelake import schemas, session
from leaguelake.functions import derive, localtime
from leaguelake.operators import analytics, delivery, flatten, ledger, merge, partitions, quality
from leaguelake.plans import medallion
from leaguelake.session import held, in_rounds, scratch_path, spread, stored_bytes
from leaguelake.sources import bridge, documents, drift, manifest
from leaguelake.streaming import incremental

TITLE = "Resultados"
LANDED = "lz4"  # codec of landed documents; files are as many as the tasks that wrote them
LANDED_LINES = "gzip"  # of documents with player lines, which take much more disk
READ_DAYS = (dt.date(1997, 3, 15), dt.date(2050, 1, 1))

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    @wraps(run)
    def at_size(spark: SparkSession, sf_dir: str) -> DataFrame:
        spread(spark, *_sources(sf_dir))
        return run(spark, sf_dir)

    REGISTRY[run.__name__] = at_size
    return at_size


def parsed_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bridge.schedule_documents(bridge.games(spark, sf_dir))
    return documents.parse_documents(raw, schemas.SCHEDULE_DOCUMENT)


def _sources(sf_dir: str) -> list[str]:
    return [f"{sf_dir}/{table}.parquet" for table in ("orders", "lineitem")]


def _boxscores_in_rounds(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame], None]) -> None:
    """Typed box scores to ``write``, a share of the games at a time, so that their shuffles do not lie on disk all at once."""
    rounds = -(-stored_bytes(spark, *_sources(sf_dir)) // session.BYTES_PER_ROUND)
    in_rounds(spark, "game_no", max(1, rounds), lambda wanted: write(bridge.boxscore_rows(spark, sf_dir, wanted)))


def parsed_boxscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "boxscores")
    _boxscores_in_rounds(spark, sf_dir, lambda rows: rows.write.mode("append").parquet(path))
    stored = spark.read.schema(bridge.boxscore_rows(spark, sf_dir).schema).parquet(path)
    return documents.parse_documents(bridge.boxscore_text(stored), schemas.BOXSCORE_DOCUMENT)


def parsed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.parse_documents(bridge.boxscore_headers(spark, sf_dir), schemas.BOXSCORE_HEADER)


def gold_facts(spark: SparkSession, sf_dir: str, team_columns: bool = False) -> DataFrame:
    return merge.player_facts(bridge.silver_player_stats(spark, sf_dir, names=False, team_columns=team_columns))


def stored_facts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Columns of the same facts as a stored table, for queries that read them more than once."""
    return held(gold_facts(spark, sf_dir).select("game_id", "player_id", *columns), "facts")


def gold_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.players_dimension(bridge.silver_player_stats(spark, sf_dir, team_columns=False))


def typed_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game key, start, status and type, without team lookups."""
    return bridge.game_keys(spark, sf_dir).withColumn("game_type", derive.game_type(F.col("game_id")))


# Bronze to Silver


@query
def schedule_flatten(spark, sf_dir):
    return flatten.silver_schedule(parsed_schedule(spark, sf_dir))


@query
def schedule_broadcasters(spark, sf_dir):
    games = flatten.project_schedule(flatten.schedule_games(parsed_schedule(spark, sf_dir)))
    return games.select("game_id", "us_broadcaster", "brazil_broadcaster")


@query
def game_type(spark, sf_dir):
    return typed_games(spark, sf_dir).select("game_id", "game_type")


@query
def series_wins(spark, sf_dir):
    games = bridge.games(spark, sf_dir).withColumn("game_type", derive.game_type(F.col("game_id")))
    parsed = derive.with_series_wins(
        games, F.col("series_text"), derive.home_code(F.col("game_code")), derive.away_code(F.col("game_code"))
    )
    playoff = F.col("game_type") == "playoff"
    return parsed.select(
        "game_id",
        F.col("home_series_wins").alias("parsed_home_wins"),
        F.col("away_series_wins").alias("parsed_away_wins"),
        F.when(playoff, F.col("home_series_wins")).alias("home_series_wins"),
        F.when(playoff, F.col("away_series_wins")).alias("away_series_wins"),
    )


@query
def boxscore_silver(spark, sf_dir):
    return flatten.silver_boxscores(parsed_headers(spark, sf_dir))


@query
def player_lines(spark, sf_dir):
    return flatten.silver_player_stats(parsed_boxscores(spark, sf_dir))


# manifests


@query
def wanted_manifest(spark, sf_dir):
    return manifest.wanted_games(parsed_schedule(spark, sf_dir))


@query
def completed_manifest(spark, sf_dir):
    return manifest.completed_games(parsed_schedule(spark, sf_dir))


def _completed(spark, sf_dir):
    return bridge.game_keys(spark, sf_dir).filter(F.col("game_status") == derive.FINAL_STATUS).select("dt", "game_id")


@query
def missing_games(spark, sf_dir):
    landed = bridge.landed_games(spark, sf_dir).select(documents.path_game_id(F.col("path")).alias("game_id"))
    return manifest.missing_games(_completed(spark, sf_dir), landed)


@query
def pending_dates(spark, sf_dir):
    games = bridge.game_keys(spark, sf_dir).select("dt", "game_status")
    return manifest.pending_dates(games, games.filter("game_status = 3"), games.filter("game_status = 2"))


@query
def ingest_audit(spark, sf_dir):
    landed = bridge.landed_games(spark, sf_dir).select(
        documents.path_game_id(F.col("path")).alias("game_id"), "landed_at"
    )
    return manifest.ingest_audit(_completed(spark, sf_dir), landed, bridge.RUN_START)


@query
def source_selection(spark, sf_dir):
    games = bridge.games(spark, sf_dir).withColumn("source", F.concat(F.lit("feed_"), F.col("priority")))
    candidates = documents.parse_documents(
        bridge.schedule_documents(games, "source", "priority"), schemas.SCHEDULE_DOCUMENT
    )
    # above the mean of the five feeds, so some are accepted and some are not, however large the tables are
    return manifest.source_report(candidates, bridge.load(spark, sf_dir, "orders").count() // 5 + 1)


@query
def latest_snapshot(spark, sf_dir):
    both = bridge.snapshots(bridge.game_keys(spark, sf_dir))
    return documents.latest_snapshot(both, "snapshot").select("snapshot", "game_id", "game_status")


# gates, reads


@query
def silver_gates(spark, sf_dir):
    """All gates over the tables as they are, and over the same rows with planted faults."""
    games = flatten.schedule_games(parsed_schedule(spark, sf_dir))
    number = F.substring("game_id", 4, 20).cast("bigint")
    ids = games.select(F.col("game.gameId").alias("game_id"))
    lost = ids.withColumn("game_id", F.when(number % 4 == 0, None).when(number % 97 == 0, "0021").otherwise(F.col("game_id")))
    broken_time = F.when(F.col("game.gameStatus") == "2", "soon").otherwise(F.col("game.gameDateTimeUTC"))
    untyped = games.withColumn("game", F.col("game").withField("gameDateTimeUTC", broken_time))
    boxes = bridge.scores(bridge.lines(spark, sf_dir))
    negative = boxes.withColumn("home_score", F.when(F.col("game_no") % 89 == 0, -F.col("home_score")).otherwise(F.col("home_score")))
    lines = bridge.lines(spark, sf_dir).filter("played = '1'")
    checks = [
        ("given", ids, quality.schedule_gates()), ("planted", lost, quality.schedule_gates()),
        ("given", games, quality.schedule_value_gates()), ("planted", untyped, quality.schedule_value_gates()),
        ("given", boxes, quality.boxscore_gates()), ("planted", negative, quality.boxscore_gates()),
        ("given", lines, quality.player_gates()), ("planted", lines.filter("pts < 0"), quality.player_gates()),
    ]
    reports = [quality.gate_report(df, gates).select(F.lit(case).alias("rows"), "*") for case, df, gates in checks]
    return reduce(DataFrame.unionByName, reports)


@query
def parameterised_read(spark, sf_dir):
    schedule = typed_games(spark, sf_dir)
    text = """
        SELECT :day AS run_date, game_id, game_type, game_status
        FROM {schedule}
        WHERE game_datetime_utc >= CAST(:low AS TIMESTAMP_NTZ) AND game_datetime_utc < CAST(:high AS TIMESTAMP_NTZ)
          AND to_date(convert_timezone('UTC', :zone, game_datetime_utc)) = :day
          AND game_type NOT IN ('preseason') AND (game_status >= 1 OR game_status IS NULL)
    """
    reads = []
    for day in READ_DAYS:
        low, high = (moment.isoformat(" ") for moment in localtime.utc_bounds(day))
        args = {"day": day, "zone": localtime.LOCAL_ZONE, "low": low, "high": high}
        reads.append(documents.read_sql(spark, text, args, schedule=schedule))
    return reads[0].unionByName(reads[1])


# Gold maintenance


@query
def dim_players(spark, sf_dir):
    return gold_players(spark, sf_dir).drop("dt")


@query
def fact_player_game_stats(spark, sf_dir):
    return gold_facts(spark, sf_dir, team_columns=True).drop("dt")


def _gold_schedule(games: DataFrame) -> DataFrame:
    """Gold schedule as the first snapshot left it, with a poll id on every third game."""
    stored = bridge.silver_schedule(games, "game_no")
    with_polls = stored.withColumn("poll_message_id", F.when(F.col("game_no") % 3 == 0, F.col("game_no") * 10))
    return merge.add_missing(with_polls, schemas.GOLD_SCHEDULE_EXTRAS).drop("game_no")


@query
def upsert_schedule(spark, sf_dir):
    both = bridge.snapshots(bridge.games(spark, sf_dir))
    target = _gold_schedule(both.filter(F.col("snapshot") == F.lit(bridge.FIRST_SNAPSHOT)))
    batch = bridge.silver_schedule(both.filter(F.col("snapshot") == F.lit(bridge.SECOND_SNAPSHOT)))
    update = [c for c in batch.columns if c != "game_id"]
    return merge.upsert(target, batch, "game_id", update)


@query
def latest_wins(spark, sf_dir):
    both = bridge.snapshots(typed_games(spark, sf_dir))
    newest = merge.latest_per_key(both, ["game_id"], "snapshot")
    return newest.select("game_id", "game_status", "snapshot")


@query
def partition_overwrite(spark, sf_dir):
    path = scratch_path(spark, "overwrite")
    month = F.trunc("dt", "MM")
    both = bridge.snapshots(bridge.game_keys(spark, sf_dir)).select(
        month.alias("month"), "game_id", "game_status", "snapshot"
    )
    partitions.replace(both.filter(F.col("snapshot") == F.lit(bridge.FIRST_SNAPSHOT)), path, "month")
    later = both.filter((F.col("snapshot") == F.lit(bridge.SECOND_SNAPSHOT)) & (F.col("month") >= "1998-01-01"))
    partitions.replace(later, path, "month")
    return partitions.read(spark, path)


@query
def table_upsert(spark, sf_dir):
    """A stored table takes the second snapshot, then the older first one with its games under another date, then a
    patch with a new column: older rows change nothing, keys may move, and the default reaches stored rows."""
    path = scratch_path(spark, "upsert")
    both = bridge.snapshots(bridge.game_keys(spark, sf_dir)).select("game_no", "game_id", "dt", "game_status", "snapshot")

    def of(day) -> DataFrame:
        return both.filter(F.col("snapshot") == F.lit(day)).drop("game_no")

    partitions.merge(spark, path, of(bridge.SECOND_SNAPSHOT), "game_id", "snapshot")
    partitions.merge(spark, path, of(bridge.FIRST_SNAPSHOT).withColumn("dt", F.date_add("dt", 1)), "game_id", "snapshot")
    moved = both.filter((F.col("snapshot") == F.lit(bridge.SECOND_SNAPSHOT)) & (F.col("game_no") % 10 == 0))
    moved = moved.select("game_id", F.date_add("dt", 30).alias("dt"), F.date_add("snapshot", 1).alias("snapshot"))
    partitions.merge(spark, path, moved, "game_id", "snapshot", ["dt", "snapshot"], {"is_cancelled": ("boolean", False)})
    return partitions.read(spark, path)


@query
def cancel_replay(spark, sf_dir):
    """Cancellations after a snapshot without some games, and after the next one that lists them again."""
    path = scratch_path(spark, "cancel")
    # every load and every cancellation reads a snapshot, so both come from one held table
    silver = held(bridge.silver_schedule(bridge.snapshots(bridge.games(spark, sf_dir)), "snapshot"), "snapshots")
    days = [bridge.FIRST_SNAPSHOT, bridge.SECOND_SNAPSHOT]
    snapshots = [silver.filter(F.col("snapshot") == F.lit(day)) for day in days]
    snapshots.append(snapshots[0].withColumn("snapshot", F.date_add("snapshot", 2)))
    steps = []
    for step, snapshot in enumerate(snapshots):
        medallion.load_schedule(spark, path, snapshot)
        medallion.cancel(spark, path, snapshot)
        steps.append(held(partitions.read(spark, path).select(F.lit(step + 1).alias("step"), "game_id", "is_cancelled"), "step"))
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


# files


def _landed_schedule(spark, sf_dir) -> str:
    """Both schedule snapshots as files below a folder of their date, one document to a line."""
    landing = scratch_path(spark, "landing")
    both = bridge.snapshots(bridge.games(spark, sf_dir))
    for snapshot in (bridge.FIRST_SNAPSHOT, bridge.SECOND_SNAPSHOT):
        raw = bridge.schedule_documents(both.filter(F.col("snapshot") == F.lit(snapshot)))
        raw.write.option("compression", LANDED).text(f"{landing}/{snapshot}")
    return landing


@query
def file_scan_schedule(spark, sf_dir):
    folders = documents.date_folders(spark, _landed_schedule(spark, sf_dir))
    rows = documents.read_documents(spark, folders, schemas.SCHEDULE_DOCUMENT, multi_line=False)
    return flatten.silver_schedule(rows, ["dt"]).withColumnRenamed("dt", "snapshot")


def _landed_boxscores(spark, sf_dir) -> str:
    """Box scores as compressed files of their date, one document to a line; JSON repeats its field names for every line."""
    landing = scratch_path(spark, "landing")

    def land(rows: DataFrame) -> None:
        docs = bridge.boxscore_text(rows).select("doc")
        docs.write.mode("append").option("compression", LANDED_LINES).text(f"{landing}/{bridge.FIRST_SNAPSHOT}")

    _boxscores_in_rounds(spark, sf_dir, land)
    return landing


@query
def file_scan_boxscores(spark, sf_dir):
    folders = documents.date_folders(spark, _landed_boxscores(spark, sf_dir))
    rows = documents.read_documents(spark, folders, schemas.BOXSCORE_DOCUMENT, multi_line=False)
    return flatten.silver_player_stats(rows, ["dt"]).withColumnRenamed("dt", "landed")


@query
def table_roundtrip(spark, sf_dir):
    """A table created from its schema, written with the schema checked, and read back for a date it has and one it lacks."""
    path = scratch_path(spark, "roundtrip")
    games = bridge.games(spark, sf_dir)
    partitions.create(spark, path, StructType([*schemas.SILVER_SCHEDULE.fields, StructField("dt", DateType())]), "dt")
    silver = bridge.silver_schedule(games, "dt")
    merge.assert_schema(silver.drop("dt"), schemas.SILVER_SCHEDULE)
    partitions.replace(silver, path)
    present, absent = (documents.read_partition(spark, path, day, schemas.SILVER_SCHEDULE) for day in READ_DAYS)
    return present.unionByName(absent)


@query
def pk_violations(spark, sf_dir):
    lines = bridge.silver_player_stats(spark, sf_dir, names=False, team_columns=False)
    return quality.key_violations(lines, ["game_id", "player_id"])


@query
def cancel_phantoms(spark, sf_dir):
    both = bridge.snapshots(bridge.games(spark, sf_dir))
    current = both.filter(F.col("snapshot") == F.lit(bridge.SECOND_SNAPSHOT))
    stored = merge.latest_per_key(bridge.silver_schedule(both, "game_no", "snapshot"), ["game_id"], "snapshot")
    stored = stored.withColumn("is_cancelled", F.col("game_no") % 50 == 0)
    return merge.cancel_phantoms(stored, current).select("game_id", "is_cancelled", "newly_cancelled")


@query
def patch_column(spark, sf_dir):
    keys = bridge.game_keys(spark, sf_dir)
    patches = keys.filter("priority = 5").select(
        "game_id", F.when(F.col("game_status") == 1, F.col("game_no") + 1).alias("poll_message_id")
    )
    return merge.patch_column(_open_polls(spark, sf_dir), patches, "game_id", "poll_message_id")


# contracts


def _gold_boxscores(spark, sf_dir, lines=None):
    """Box scores from keys and scores alone; contracts read no team name."""
    lines = bridge.lines(spark, sf_dir) if lines is None else lines
    games = typed_games(spark, sf_dir).join(bridge.scores(lines), "game_no")
    return games.withColumns(
        {
            "is_final": derive.is_final(F.col("game_status")),
            "winner": derive.winner(F.col("away_score"), F.col("home_score")),
        }
    )


@query
def contract_suite_gold(spark, sf_dir):
    return quality.contract_suite(
        typed_games(spark, sf_dir),
        _gold_boxscores(spark, sf_dir),
        stored_facts(
            spark, sf_dir, "side", "pts", "fgm", "fga", "tpm", "tpa", "ftm", "fta", "fg_pct", "tp_pct", "ft_pct"
        ),
        bridge.player_names(spark, sf_dir),
    )


def _planted_gold(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Schedule, box scores, player lines and players with a planted violation of each kind. Rows are altered, none left
    out: an altered key is missing on one side and unknown on the other."""
    number, part = F.col("game_no"), F.col("part_id")

    def changed(test: Column, value: object, column: str) -> Column:
        return F.when(test, value).otherwise(F.col(column))

    def lost(test: Column) -> Column:
        return changed(test, F.concat(F.lit("X"), F.col("game_id")), "game_id")

    schedule = typed_games(spark, sf_dir).withColumns(
        {"game_id": lost(number % 89 == 0), "game_type": changed(number % 83 == 0, "exhibition", "game_type")}
    )
    boxes = _gold_boxscores(spark, sf_dir).withColumns(
        {
            "game_id": lost(number % 79 == 0),
            "home_score": changed(number % 73 == 0, -F.col("home_score"), "home_score"),
            "winner": changed(number % 71 == 0, "away", "winner"),
        }
    )
    ids = typed_games(spark, sf_dir).select("game_no", "game_id")
    facts = (
        bridge.lines(spark, sf_dir)
        .filter("played = '1'")
        .join(ids, "game_no")
        .withColumns(
            {
                "game_id": lost(number % 67 == 0),
                "side": changed((number + F.col("reb")) % 61 == 0, "bench", "side"),
                "fg_pct": changed(part % 59 == 0, 1.5, "fg_pct"),
                "pts": changed(part % 53 == 0, -F.col("pts"), "pts"),
                "fgm": changed(part % 47 == 0, F.col("fga") + 1, "fgm"),
            }
        )
    )
    players = bridge.player_names(spark, sf_dir).withColumn(
        "player_id", changed(F.col("player_id") % 43 == 0, -1 - F.col("player_id"), "player_id")
    )
    columns = ["game_id", "player_id", "side", "pts", "fgm", "fga", "tpm", "tpa", "ftm", "fta", *schemas.PERCENTAGES]
    return [schedule, boxes, facts.select(*columns), players]


@query
def contract_suite(spark, sf_dir):
    """All contracts over whole tables with planted violations."""
    schedule, boxes, facts, players = _planted_gold(spark, sf_dir)
    return quality.contract_suite(schedule, boxes, held(facts, "facts"), players)


@query
def contract_ledger(spark, sf_dir):
    """The same counts kept up to date: a third of each table's games comes later, and only games with later rows are
    counted again."""
    names = (*ledger.GAME_TABLES, "players")
    paths = {name: scratch_path(spark, name) for name in names}
    counts = scratch_path(spark, "ledger")
    tables = dict(zip(names, _planted_gold(spark, sf_dir)))
    tables.pop("players").select("player_id").write.parquet(paths["players"])
    tables = {name: held(df.select(*ledger.COLUMNS[name].fieldNames()), name) for name, df in tables.items()}
    for later in (False, True):
        came = []
        for name, df in tables.items():
            is_later = F.pmod(F.xxhash64(F.lit(name), "game_id"), F.lit(3)) == 0
            now = df.filter(is_later == later)
            blocked = now.withColumn(partitions.BLOCK, partitions.block_of("game_id")).hint("rebalance", partitions.BLOCK)
            blocked.write.mode("append").partitionBy(partitions.BLOCK).parquet(paths[name])
            came.append(now.select("game_id"))
        ledger.update(spark, counts, reduce(DataFrame.unionByName, came), paths)
    return ledger.report(spark, counts)


# delivery


def digest_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents to the result lines of every local date."""
    schedule = flatten.silver_schedule(parsed_schedule(spark, sf_dir))
    return delivery.result_lines(schedule, flatten.silver_boxscores(parsed_headers(spark, sf_dir)))


@query
def results_digest(spark, sf_dir):
    boxes = bridge.silver_boxscores(spark, sf_dir, bridge.games(spark, sf_dir))
    return delivery.result_lines(bridge.game_keys(spark, sf_dir), boxes)


@query
def results_message(spark, sf_dir):
    """The messages of two local dates, one with results and one without."""
    schedule = bridge.game_keys(spark, sf_dir)
    boxes = bridge.silver_boxscores(spark, sf_dir, bridge.games(spark, sf_dir))
    first, second = (delivery.results_message(schedule, boxes, TITLE, day) for day in READ_DAYS)
    return first.unionByName(second)


@query
def results_digest_documents(spark, sf_dir):
    return digest_from_documents(spark, sf_dir)


@query
def due_polls(spark, sf_dir):
    polls = delivery.due_polls(_gold_schedule(bridge.games(spark, sf_dir)))
    return polls.select(
        "local_date", "game_datetime_utc", "game_id", "header", "question",
        F.get("options", F.lit(0)).alias("away_option"), F.get("options", F.lit(1)).alias("home_option"),
    )


def _open_polls(spark, sf_dir):
    number = F.col("game_no")
    return bridge.game_keys(spark, sf_dir).select(
        "game_id", "game_datetime_utc", F.when(number % 3 == 0, number * 10).alias("poll_message_id")
    )


@query
def poll_close(spark, sf_dir):
    return delivery.polls_to_close(_open_polls(spark, sf_dir), bridge.NOW)


@query
def poll_clear(spark, sf_dir):
    polls = _open_polls(spark, sf_dir)
    patch = delivery.closed_poll_patch(delivery.polls_to_close(polls, bridge.NOW))
    return merge.patch_column(polls, patch, "game_id", "poll_message_id")


@query
def outbox(spark, sf_dir):
    games = bridge.game_keys(spark, sf_dir).select(
        localtime.local_date(F.col("game_datetime_utc")).alias("sent_date"), "game_status"
    )

    def dates(channel: str, *statuses: int) -> DataFrame:
        return games.filter(F.col("game_status").isin(*statuses)).select("sent_date", F.lit(channel).alias("channel"))

    wanted = dates("polls", 1, 2, 3).unionByName(dates("results", 3))
    ledger = dates("polls", 1).unionByName(dates("results", 2))
    return merge.reserve_once(wanted, ledger, ["sent_date", "channel"])


# analytics


@query
def leaders(spark, sf_dir):
    return analytics.leaders(gold_facts(spark, sf_dir), bridge.player_names(spark, sf_dir))


@query
def player_form(spark, sf_dir):
    return analytics.player_form(stored_facts(spark, sf_dir, "pts"), bridge.game_keys(spark, sf_dir))


@query
def team_efficiency(spark, sf_dir):
    return analytics.team_efficiency(gold_facts(spark, sf_dir, team_columns=True))


@query
def position_distribution(spark, sf_dir):
    # facts and dimension come from one held table of lines
    lines = held(bridge.silver_player_stats(spark, sf_dir, team_columns=False), "lines")
    return analytics.position_distribution(merge.player_facts(lines), merge.players_dimension(lines))


@query
def plus_minus_context(spark, sf_dir):
    # facts and scores come from one held table of lines
    lines = held(bridge.lines(spark, sf_dir), "lines")
    facts = merge.player_facts(bridge.silver_player_stats(spark, sf_dir, names=False, team_columns=False, base=lines))
    return analytics.plus_minus_context(facts, typed_games(spark, sf_dir), _gold_boxscores(spark, sf_dir, lines))


@query
def advanced_metrics(spark, sf_dir):
    return analytics.advanced_metrics(
        stored_facts(spark, sf_dir, "side", "pts", "fga", "fta", "tov", "minutes")
    )


# streaming


@query
def incremental_silver(spark, sf_dir):
    """Two snapshots land as files, newest first; each drop is drained by its own streaming run."""
    landing, table, progress = (scratch_path(spark, n) for n in ("landing", "silver", "progress"))
    both = bridge.snapshots(bridge.games(spark, sf_dir))
    for snapshot in (bridge.SECOND_SNAPSHOT, bridge.FIRST_SNAPSHOT):
        raw = bridge.schedule_documents(both.filter(F.col("snapshot") == F.lit(snapshot)))
        raw.write.option("compression", LANDED).text(f"{landing}/{snapshot}")
        incremental.follow_schedule(spark, landing, table, progress, multi_line=False)
    return partitions.read(spark, table)


@query
def incremental_boxscores(spark, sf_dir):
    """Box scores land twice, the corrected later day first; the earlier day must not bring the old scores back."""
    names = ("landing", "boxscores", "players", "progress")
    landing, boxes, players, progress = (scratch_path(spark, n) for n in names)
    raw = bridge.boxscore_headers(spark, sf_dir).select("doc")
    corrected = F.regexp_replace("doc", '"score":(\\d+)', '"score":1$1')
    raw.select(corrected).write.text(f"{landing}/{bridge.SECOND_SNAPSHOT}")
    incremental.follow_boxscores(spark, landing, boxes, players, progress, multi_line=False)
    raw.write.text(f"{landing}/{bridge.FIRST_SNAPSHOT}")
    incremental.follow_boxscores(spark, landing, boxes, players, progress, multi_line=False)
    return partitions.read(spark, boxes).select("game_id", "home_score", "away_score", "winner", "dt")


def _planted(doc: Column, number: Column) -> Column:
    """A box score document cut off, without its game id, or with a score that is below zero or no number."""
    return (
        F.when(number % 11 == 0, F.expr("left(doc, length(doc) div 2)"))
        .when(number % 13 == 0, F.regexp_replace(doc, '"gameId":"[^"]*"', '"gameId":null'))
        .when(number % 17 == 0, F.regexp_replace(doc, '"score":(\\d+)', '"score":-1$1'))
        .when(number % 19 == 0, F.regexp_replace(doc, '"score":(\\d+)', '"score":"many"'))
        .otherwise(doc)
    )


@query
def quarantine(spark, sf_dir):
    """Box scores land with broken ones among them: what is stored, by game, and what waits as a dead letter, by reason."""
    names = ("landing", "boxscores", "players", "progress")
    landing, boxes, players, progress = (scratch_path(spark, n) for n in names)
    raw = bridge.boxscore_headers(spark, sf_dir)
    raw.select(_planted(F.col("doc"), F.regexp_extract("doc", '"gameId":"(\\d+)"', 1).cast("bigint"))).write.text(f"{landing}/{bridge.FIRST_SNAPSHOT}")
    incremental.follow_boxscores(spark, landing, boxes, players, progress, multi_line=False)
    stored = partitions.read(spark, boxes).select(F.lit("stored").alias("what"), "game_id", F.lit(1).cast("bigint").alias("documents"))
    letters = incremental.dead_letters(spark, f"{boxes}_dead_letters").groupBy(F.col("reason").alias("what")).agg(F.sum("documents").alias("documents"))
    return stored.unionByName(letters.select("what", F.lit(None).cast("string").alias("game_id"), "documents"))


def _drifted(doc: Column, number: Column) -> Column:
    """A box score document with fields and shapes that its read schema does not know, some cut off."""
    changes = [
        (7, '^\\{"game":\\{', '{"game":{"arena":{"name":"x"},'),
        (11, '"gameStatus":(\\d+|null)', '"gameStatus":{"code":$1}'),
        (13, '"players":\\[\\]', '"players":[7,8,"x"]'),
        (19, '"awayTeam":', '"guestTeam":'),
    ]
    for step, sought, new in changes:
        doc = F.when(number % step == 0, F.regexp_replace(doc, sought, new)).otherwise(doc)
    return F.when(number % 17 == 0, F.substring(doc, 1, 60)).otherwise(doc)


@query
def schema_drift(spark, sf_dir):
    """What a read of landed box scores would lose or misread: unknown fields, other shapes, truncated documents."""
    landing = f"{scratch_path(spark, 'landing')}/{bridge.FIRST_SNAPSHOT}"
    raw = bridge.boxscore_headers(spark, sf_dir)
    raw.select(_drifted(F.col("doc"), F.regexp_extract("doc", '"gameId":"(\\d+)"', 1).cast("bigint"))).write.text(landing)
    return drift.landed_drift(spark, [landing], schemas.BOXSCORE_DOCUMENT, multi_line=False)
