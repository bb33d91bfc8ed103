"""Bronze to Silver as documents land: new files only, safe to replay, in any order of arrival.

Every document is judged for itself before anything is stored. A document that is truncated, lacks its root, or breaks a
gate goes to a dead-letter table with its reasons; all others of the same drop are stored. A dead letter is read again
when its file has changed since, and leaves the table when the file is sound.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from leaguelake import schemas
from leaguelake.functions import derive
from leaguelake.operators import flatten, merge, partitions, quality
from leaguelake.session import held_at, release
from leaguelake.sources import documents as sources
from leaguelake.sources.documents import BROKEN, path_date

NUMBERS = ["game.gameStatus", "game.homeTeam.score", "game.awayTeam.score"]


def _reasons(**tests: Column) -> Column:
    """Names of the tests that hold."""
    return F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]), lambda name: name.isNotNull())


def _untyped(raw: Column, typed: Column) -> Column:
    return raw.isNotNull() & (raw != "") & typed.isNull()


def schedule_reasons(min_games: int = 0) -> Column:
    """Why a schedule document may not be stored; empty for a sound one."""
    days = F.col("leagueSchedule.gameDates")
    games = F.flatten(F.transform(F.coalesce(days, F.array()), lambda day: F.coalesce(day["games"], F.array())))
    ids = F.filter(F.transform(games, lambda game: game["gameId"]), lambda game_id: game_id.isNotNull())
    known, all_games = F.size(ids), F.size(games)
    readable = F.col(BROKEN).isNull()
    return _reasons(
        unreadable=~readable,
        no_schedule=readable & days.isNull(),
        too_few_games=readable & days.isNotNull() & (known < min_games),
        ids_lost=readable & (all_games - known > quality.MAX_LOSS * all_games),
        ids_repeated=readable & (F.size(F.array_distinct(ids)) < known),
        status_untyped=F.exists(games, lambda game: _untyped(game["gameStatus"], derive.as_int(game["gameStatus"]))),
        start_untyped=F.exists(games, lambda game: _untyped(game["gameDateTimeUTC"], derive.utc_instant(game["gameDateTimeUTC"]))),
    )


def boxscore_reasons() -> Column:
    """Why a box score may not be stored; empty for a sound one."""
    readable = F.col(BROKEN).isNull()
    untyped = [_untyped(F.col(c), derive.as_int(F.col(c))) for c in NUMBERS]
    return _reasons(
        unreadable=~readable,
        no_game_id=readable & (F.coalesce(F.col("game.gameId"), F.lit("")) == ""),
        number_untyped=untyped[0] | untyped[1] | untyped[2],
        score_negative=(derive.as_int(F.col(NUMBERS[1])) < 0) | (derive.as_int(F.col(NUMBERS[2])) < 0),
    )


def _file_key(path: Column) -> Column:
    """One spelling of a path, whether Spark's listing or a row's metadata names it."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def split(batch: DataFrame, reasons: Column) -> tuple[DataFrame, DataFrame, str]:
    """Sound documents, a row (path, dt, landed_at, documents, reasons) for each file, and where both are held.

    ``reasons`` of a file is a map from reason to the number of its documents, empty for a sound file.
    """
    judged, place = held_at(batch.withColumn("_reasons", reasons), "documents")
    file = ["path", "dt", "landed_at"]
    counts = judged.groupBy(*file).agg(F.count(F.lit(1)).alias("documents"))
    # at most one row for each file and reason, of which there are seven
    broken = (
        judged.select(*file, F.explode("_reasons").alias("reason")).groupBy(*file, "reason").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*file).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("reasons"))
    )
    letters = counts.join(broken, file, "left").withColumn("reasons", F.coalesce("reasons", F.expr("cast(map() as map<string, bigint>)")))
    return judged.filter(F.size("_reasons") == 0).drop("_reasons", BROKEN), letters, place


def keep_letters(spark: SparkSession, table: str, letters: DataFrame) -> None:
    """Store broken files; a sound file empties the letter that it has there, others are not stored."""
    stored = partitions.read(spark, table)
    broken = F.size("reasons") > 0
    if stored is not None:
        open_letters = stored.filter(broken).select("path", F.lit(True).alias("_open"))
        letters = letters.join(open_letters, "path", "left").filter(broken | F.col("_open")).drop("_open")
    else:
        letters = letters.filter(broken)
    newest = merge.keep_first(letters, ["path"], [F.desc("landed_at")])
    partitions.merge(spark, table, newest, "path", version="landed_at")


def dead_letters(spark: SparkSession, table: str) -> DataFrame:
    """(path, dt, landed_at, reason, documents): what waits for a corrected file."""
    stored = partitions.read(spark, table)
    if stored is None:
        return merge.empty_table(spark, DEAD_LETTERS)
    return stored.select("path", "dt", "landed_at", F.explode("reasons").alias("reason", "documents"))


DEAD_LETTERS = StructType([*schemas.INGESTED.fields, StructField("reason", StringType()), StructField("documents", schemas.BIGINT)])
Store = Callable[[SparkSession, DataFrame], None]


def _with_file(rows: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return rows.select("*", _file_key(path).alias("path"), path_date(path).alias("dt"), F.col("_metadata.file_modification_time").alias("landed_at"))


def _schema(document: StructType) -> StructType:
    return StructType([*document.fields, StructField(BROKEN, StringType())])


def follow(
    spark: SparkSession, landing: str, document: StructType, reasons: Column, store: Store, letters: str, checkpoint: str, multi_line: bool
) -> None:
    """Store every sound document below ``landing``/<date>/ not seen before, and those of dead letters that were corrected.

    Spark's readers pass over a file without any content; its game stays wanted in the ingest audit.
    """

    def apply(batch: DataFrame, _batch_id: int | None = None) -> None:
        session = batch.sparkSession
        sound, files, place = split(batch, reasons)
        store(session, sound)
        keep_letters(session, letters, files)
        release(session, place)

    waiting = partitions.read(spark, letters)
    if waiting is not None:
        _retry(spark, waiting, document, apply, multi_line)
    stream = spark.readStream.schema(_schema(document)).option("multiLine", multi_line).json(f"{landing}/*")
    query = (
        _with_file(stream).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _retry(spark: SparkSession, waiting: DataFrame, document: StructType, apply, multi_line: bool) -> None:
    """Documents of dead letters whose file has changed since it was judged."""
    waiting = waiting.filter(F.size("reasons") > 0)
    folders = [r[0] for r in waiting.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]  # one for each date
    if not folders:
        return
    now = sources.landed_files(spark, folders).select(_file_key(F.col("path")).alias("path"), F.col("landed_at").alias("_now"))
    changed, place = held_at(waiting.join(now, "path").filter(F.col("_now") > F.col("landed_at")).select("path"), "changed")
    days = [r[0] for r in changed.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]
    if days:
        rows = _with_file(spark.read.schema(_schema(document)).option("multiLine", multi_line).json(days))
        apply(rows.join(changed, "path", "left_semi"))
    release(spark, place)


def schedule_batch(documents: DataFrame) -> DataFrame:
    """Silver rows of a batch of landed schedule documents, newest snapshot per game."""
    rows = flatten.silver_schedule(documents, ["snapshot"])
    return merge.latest_per_key(rows, ["game_id"], "snapshot")


def follow_schedule(
    spark: SparkSession, landing: str, table: str, checkpoint: str, multi_line: bool = True, letters: str | None = None, min_games: int = 0
) -> None:
    """Process every schedule file below ``landing``/<date>/ not seen before, then stop.

    Each micro-batch is a keyed merge that ignores rows older than the stored ones. A replayed batch therefore
    changes nothing, and the order in which snapshots arrive does not matter. Broken documents, and those with fewer
    games than ``min_games``, go to the dead letters at ``letters`` (by default beside the table).
    """

    def store(session: SparkSession, sound: DataFrame) -> None:
        partitions.merge(session, table, schedule_batch(sound.withColumnRenamed("dt", "snapshot")), "game_id", version="snapshot")

    follow(spark, landing, schemas.SCHEDULE_DOCUMENT, schedule_reasons(min_games), store, letters or f"{table}_dead_letters", checkpoint, multi_line)


def follow_boxscores(
    spark: SparkSession, landing: str, boxscores: str, player_stats: str, checkpoint: str, multi_line: bool = True, letters: str | None = None
) -> None:
    """Flatten every box score file not seen before into both Silver tables, merged by key.

    The landing date is the version of a row, so a file of an earlier date never replaces a row of a later one. Player
    lines keep the Silver layout; ``line_key`` is added, and Gold tables are derived from them as from any Silver lines.
    Broken documents go to the dead letters at ``letters`` (by default beside the box scores).
    """

    def store(session: SparkSession, sound: DataFrame) -> None:
        boxes = merge.latest_per_key(flatten.silver_boxscores(sound, ["dt"]), ["game_id"], "dt")
        partitions.merge(session, boxscores, boxes, "game_id", version="dt")
        lines = merge.latest_per_key(flatten.silver_player_stats(sound, ["dt"]), ["game_id", "player_id"], "dt")
        keyed, place = held_at(lines.withColumn("line_key", derive.surrogate_key(F.col("game_id"), F.col("player_id"))), "lines")
        if quality.enforce(keyed, quality.player_gates()):
            partitions.merge(session, player_stats, keyed, "line_key", version="dt")
        release(session, place)

    follow(spark, landing, schemas.BOXSCORE_DOCUMENT, boxscore_reasons(), store, letters or f"{boxscores}_dead_letters", checkpoint, multi_line)
