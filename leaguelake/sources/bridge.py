"""League-shaped data derived from the order tables, so every query works on the given tables.

An order is a game, its line items are player lines. ``*_documents`` build the nested raw documents, the
``silver_*`` functions give the same rows as typed tables (both routes are compared with SQL). Lookups keep games
and lines that find no match; Spark broadcasts what its size statistics allow.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leaguelake import schemas
from leaguelake.functions import derive
from leaguelake.operators.flatten import derive_boxscore, derive_schedule

AWAY_TEAMS = 25  # the away team is drawn from this many
EVERY_GAME = "true"  # as a condition on game_no
CALLED_OFF_BELOW = 5000.0  # orders below this price are games the second snapshot no longer lists
GAMES_PER_DOCUMENT = 64
LINES_PER_DOCUMENT = 512
ROW_VALUES = ("linenumber", "quantity", "discount", "tax", "returnflag", "linestatus")  # of line items, beside the keys
FIRST_SNAPSHOT = dt.date(2026, 1, 1)
SECOND_SNAPSHOT = dt.date(2026, 1, 2)
RUN_START = dt.datetime(1998, 6, 1)
NOW = dt.datetime(1998, 6, 1, 12, 30)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _game_id(key: Column, priority: Column) -> Column:
    digits = key.cast("string")
    return F.concat(
        F.lit("00"), F.substring(priority, 1, 1), F.lpad(digits, F.greatest(F.lit(7), F.length(digits)), F.lit("0"))
    )


def _status(letter: Column) -> Column:
    return F.when(letter == "F", 3).when(letter == "P", 2).when(letter == "O", 1)


def game_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games without team names: one row per order, no join."""
    key = F.col("o_orderkey")
    return load(spark, sf_dir, "orders").select(
        key.alias("game_no"),
        _game_id(key, F.col("o_orderpriority")).alias("game_id"),
        F.to_date("o_orderdate").alias("dt"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int"))).alias("game_datetime_utc"),
        _status(F.col("o_orderstatus")).alias("game_status"),
        F.col("o_custkey"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        (F.col("o_totalprice") < CALLED_OFF_BELOW).alias("called_off"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All teams with their city."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("city"),
        F.concat(F.lit("T"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every game with both teams, game code, series label and broadcaster names; an unknown team has no name."""
    sides = teams(spark, sf_dir)

    def side(name: str) -> DataFrame:
        return sides.select(*[F.col(c).alias(f"{name}_{c}") for c in sides.columns])

    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("home_id")
    )
    key = F.col("game_no")
    full = (
        game_keys(spark, sf_dir)
        .join(customers, "o_custkey", "left")
        .withColumn("away_id", ((F.col("home_id") + 1 + key % (AWAY_TEAMS - 1)) % AWAY_TEAMS).cast("int"))
        .join(side("home"), "home_id", "left")
        .join(side("away"), "away_id", "left")
    )
    home, away = F.col("home_code"), F.col("away_code")
    label = (
        F.when(key % 6 == 0, F.concat(home, F.lit(" leads 3-1")))
        .when(key % 6 == 1, F.concat(away, F.lit(" wins 4-2")))
        .when(key % 6 == 2, "Series tied 2-2")
        .when(key % 6 == 3, "")
        .when(key % 6 == 5, F.concat(home, F.lit(" vs "), away))
    )
    return full.withColumns(
        {
            "game_code": F.concat(F.date_format("dt", "yyyyMMdd"), F.lit("/"), away, home),
            "series_text": label,
            "us_broadcaster": F.when(key % 4 != 3, F.col("home_city")),
            "brazil_broadcaster": F.when((key + 1) % 4 != 3, F.col("away_city")),
        }
    )


def snapshots(games: DataFrame) -> DataFrame:
    """Two daily snapshots of the games in one pass: the second no longer lists games that were called off and
    finishes those that were under way."""
    both = games.withColumn("day_no", F.explode(F.array(F.lit(0), F.lit(1))))
    second = F.col("day_no") == 1
    return (
        both.filter(~second | ~F.col("called_off"))
        .withColumn("game_status", F.when(second & (F.col("game_status") == 2), 3).otherwise(F.col("game_status")))
        .withColumn("snapshot", F.date_add(F.lit(FIRST_SNAPSHOT), F.col("day_no")))
        .drop("day_no")
    )


def _broadcasters(display: Column, shape: Column) -> Column:
    """JSON text in the feed's varying shapes: list of objects, list of texts, text, empty list."""
    entry = F.to_json(F.struct(display.alias("broadcasterDisplay")))

    def as_text(raw: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(raw, F.lit('"'), F.lit('\\"')), F.lit('"'))

    def listed(raw: Column) -> Column:
        return F.concat(F.lit("["), raw, F.lit("]"))

    raw = (
        F.when(shape % 4 == 0, listed(entry))
        .when(shape % 4 == 1, listed(as_text(entry)))
        .when(shape % 4 == 2, as_text(listed(entry)))
        .otherwise("[]")
    )
    return raw


def schedule_documents(games: DataFrame, *carry: str) -> DataFrame:
    """Schedule documents (carry..., doc) of up to GAMES_PER_DOCUMENT neighbouring game numbers each.

    Game numbers are unique, so a document is bounded; both groupings share one shuffle.
    """
    key = F.col("game_no")

    def team(side: str) -> Column:
        return F.struct(F.col(f"{side}_name").alias("teamName"), F.col(f"{side}_city").alias("teamCity"))

    start = F.col("game_datetime_utc").cast("string")
    plain = F.to_json(
        F.struct(
            F.col("game_id").alias("gameId"),
            F.concat(F.translate(start, " ", "T"), F.lit("Z")).alias("gameDateTimeUTC"),
            F.col("game_status").alias("gameStatus"),
            F.col("game_code").alias("gameCode"),
            F.col("series_text").alias("seriesText"),
            team("home").alias("homeTeam"),
            team("away").alias("awayTeam"),
        )
    )
    game = F.concat(
        F.rtrim(plain, F.lit("}")),
        F.lit('},"broadcasters":{"nationalTvBroadcasters":'),
        _broadcasters(F.col("us_broadcaster"), key),
        F.lit(',"intlTvBroadcasters":'),
        _broadcasters(F.col("brazil_broadcaster"), key + 1),
        F.lit("}}"),
    )

    def joined(column: str) -> Column:
        return F.array_join(F.collect_list(column), ",")

    days = (
        games.withColumn("block", F.floor(key / GAMES_PER_DOCUMENT))
        .repartition(*carry, "block")
        .select(
            *carry,
            "block",
            F.concat(F.date_format("dt", "MM/dd/yyyy"), F.lit(" 00:00:00")).alias("label"),
            game.alias("game"),
        )
        .groupBy(*carry, "block", "label")
        .agg(
            F.concat(
                F.lit('{"gameDate":"'), F.col("label"), F.lit('","games":['), joined("game"), F.lit("]}")
            ).alias("day")
        )
    )
    return days.groupBy(*carry, "block").agg(
        F.concat(F.lit('{"leagueSchedule":{"gameDates":['), joined("day"), F.lit("]}}")).alias("doc")
    ).drop("block")


def silver_schedule(games: DataFrame, *carry: str) -> DataFrame:
    renamed = games.withColumnsRenamed(
        {f"{side}_{column}": f"{side}_team_{column}" for side in ("home", "away") for column in ("city", "name")}
    )
    return derive_schedule(renamed, carry)


def _row_values(spark: SparkSession, sf_dir: str, *place: Column) -> DataFrame:
    """What a player line is made of: the values of its row that are not repeated in another form."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("game_no"),
        F.col("l_suppkey").alias("player_id"),
        F.col("l_partkey").alias("part_id"),
        *[F.col(f"l_{name}").alias(name) for name in ROW_VALUES],
        *place,
    )


def _line(row: Callable[[str], Column]) -> dict[str, Column]:
    """Side, flags and statistics of a player line; ``row`` gives a value of ``_row_values`` by name."""
    number, part, player = row("linenumber"), row("part_id"), row("player_id")
    points = row("quantity").cast("int")
    clock = F.lpad((part % 60).cast("string"), 2, "0")
    minutes = (
        F.when(number % 3 == 0, F.concat(F.lit("PT"), points, F.lit("M"), clock, F.lit(".00S")))
        .when(number % 3 == 1, F.concat(points, F.lit(":"), clock))
        .otherwise("")
    )
    stat = {
        "minutes": minutes,
        "pts": points,
        "reb": number,
        "ast": part % 10,
        "stl": player % 5,
        "blk": part % 4,
        "tov": (part + player) % 6,
        "plus_minus": points - 25,
        "fgm": points,
        "fga": points + number,
        "fg_pct": row("discount"),
        "tpm": part % 5,
        "tpa": part % 5 + number,
        "tp_pct": row("tax"),
        "ftm": player % 7,
        "fta": player % 7 + part % 3,
        "ft_pct": row("discount") + row("tax"),
        "reb_off": number % 3,
        "reb_def": number - number % 3,
    }
    kinds = {f.name: f.dataType for f in schemas.SILVER_PLAYER_STATS.fields}
    return {
        "side": F.when(row("linestatus") == "O", "home").otherwise("away"),
        "played": F.when(row("returnflag") == "N", "0").otherwise("1"),
        "starter": F.when(number <= 2, 1).otherwise(0),
        **{name: column.cast(kinds[name]) for name, column in stat.items()},
    }


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player lines: one row per line item with its game number, side and statistics."""
    line = {name: column.alias(name) for name, column in _line(F.col).items()}
    return _row_values(spark, sf_dir).select("game_no", line.pop("side"), "player_id", "part_id", *line.values())


def with_player_names(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_id"), F.col("p_type").alias("position"))
    return lines.join(player_names(spark, sf_dir), "player_id", "left").join(parts, "part_id", "left")


def scores(lines: DataFrame) -> DataFrame:
    """(game_no, home_score, away_score); a side without lines has no score."""

    def side(name: str) -> Column:
        return F.sum(F.when(F.col("side") == name, F.col("pts"))).cast("int")

    return lines.groupBy("game_no").agg(side("home").alias("home_score"), side("away").alias("away_score"))


def silver_boxscores(spark: SparkSession, sf_dir: str, games: DataFrame) -> DataFrame:
    """Silver box scores plus ``dt``; a game without lines has none."""
    named = games.select(
        "game_no", "dt", "game_id", "game_status",
        F.col("away_city").alias("away_team_city"), F.col("away_name").alias("away_team_name"),
        F.col("home_city").alias("home_team_city"), F.col("home_name").alias("home_team_name"),
    )
    return derive_boxscore(named.join(scores(lines(spark, sf_dir)), "game_no"), ["dt"])


def player_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("player_name")
    )


def silver_player_stats(
    spark: SparkSession, sf_dir: str, names: bool = True, team_columns: bool = True, base: DataFrame | None = None
) -> DataFrame:
    """Silver player lines plus ``dt``. ``names`` and ``team_columns`` False leave out lookups (and columns)
    the caller does not read; ``base`` may give the lines as a stored table."""
    played = (lines(spark, sf_dir) if base is None else base).filter("played = '1'")
    columns = schemas.SILVER_PLAYER_STATS.fieldNames()
    if names:
        played = with_player_names(played, spark, sf_dir)
    else:
        columns = [c for c in columns if c not in ("player_name", "position")]
    if not team_columns:
        columns = [c for c in columns if not c.startswith("team_")]
        return played.join(game_keys(spark, sf_dir), "game_no").select("dt", *columns)

    def team(column: str) -> Column:
        at_home = F.col("side") == "home"
        return F.when(at_home, F.col(f"home_{column}")).otherwise(F.col(f"away_{column}"))

    return (
        played.join(games(spark, sf_dir), "game_no")
        .withColumns(
            {"team_id": team("id").cast("bigint"), "team_city": team("city"), "team_name": team("name")}
        )
        .select("dt", *columns)
    )


def _headers(spark: SparkSession, sf_dir: str, wanted: Column | str) -> DataFrame:
    return games(spark, sf_dir).filter(wanted).join(scores(lines(spark, sf_dir).filter(wanted)), "game_no")


def _boxscore_document(players: dict[str, Column]) -> Column:
    """A document from the header columns and the JSON list of each side's players."""

    def team(side: str) -> Column:
        plain = F.to_json(
            F.struct(
                F.col(f"{side}_id").alias("teamId"), F.col(f"{side}_city").alias("teamCity"),
                F.col(f"{side}_name").alias("teamName"), F.col(f"{side}_score").alias("score"),
            )
        )
        opened = F.rtrim(plain, F.lit("}"))
        comma = F.when(F.length(opened) > 1, ",").otherwise("")
        return F.concat(opened, comma, F.lit('"players":'), players[side], F.lit("}"))

    return F.concat(
        F.lit('{"game":{"gameId":"'), F.col("game_id"), F.lit('","gameStatus":'), F.coalesce(F.col("game_status").cast("string"), F.lit("null")),
        F.lit(',"homeTeam":'), team("home"), F.lit(',"awayTeam":'), team("away"), F.lit("}}"),
    )


def boxscore_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One box score document (dt, doc) per game, without players; no player line is put into a list."""
    none = F.lit("[]")
    return _headers(spark, sf_dir, EVERY_GAME).select("dt", _boxscore_document({"home": none, "away": none}).alias("doc"))


def boxscore_rows(spark: SparkSession, sf_dir: str, wanted: Column | str = EVERY_GAME) -> DataFrame:
    """Box scores as typed values: one row per document, with the header and the row values of each side's players.

    ``wanted`` is a condition on game_no; other games' lines are not shuffled.

    A document has the players of at most LINES_PER_DOCUMENT neighbouring rows of a source file. The lines of a game thus come in
    one document for each stretch of a file that holds some, each with the game's header, and no task gathers all lines of one
    game. Lines are shuffled, sorted and joined as the values of their rows; the statistics made of them, and the JSON text,
    many times as long, come last.
    """
    # two files of one number would at most share a document
    place = [F.xxhash64("_metadata.file_path").alias("row_file"), F.expr(f"_metadata.row_index div {LINES_PER_DOCUMENT}").alias("stretch")]
    named = with_player_names(_row_values(spark, sf_dir, *place).filter(wanted), spark, sf_dir)
    player = F.struct(*[c for c in named.columns if c not in ("game_no", "linestatus", "row_file", "stretch")])
    at_home = F.coalesce(F.col("linestatus") == "O", F.lit(False))
    grouped = named.groupBy("game_no", "row_file", "stretch").agg(
        F.collect_list(F.when(at_home, player)).alias("home_players"),
        F.collect_list(F.when(~at_home, player)).alias("away_players"),
    )
    return grouped.drop("row_file", "stretch").join(_headers(spark, sf_dir, wanted), "game_no").select(
        "dt", "game_id", "game_status",
        *[f"{side}_{column}" for side in ("home", "away") for column in ("id", "city", "name", "score", "players")],
    )


def boxscore_text(rows: DataFrame) -> DataFrame:
    """Box score documents (dt, doc) of typed rows."""

    def listed(row: Column) -> Column:
        line = _line(lambda name: F.lit(None).cast("string") if name == "linestatus" else row[name])
        return F.struct(
            row["player_id"].alias("personId"),
            row["player_name"].alias("name"),
            row["position"].alias("position"),
            line["starter"].cast("string").alias("starter"),
            line["played"].alias("played"),
            F.when(line["played"] == "0", "INACTIVE").alias("notPlayingReason"),
            F.struct(*[line[c].alias(f) for c, f in schemas.STATISTIC_FIELDS.items()]).alias("statistics"),
        )

    doc = _boxscore_document({side: F.to_json(F.transform(f"{side}_players", listed)) for side in ("home", "away")})
    return rows.select("dt", doc.alias("doc"))


def boxscore_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box score documents (dt, doc) of ``boxscore_rows``."""
    return boxscore_text(boxscore_rows(spark, sf_dir))


def landed_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dt, path, landed_at): the box score file of each game that has lines, by the day it first shipped."""
    shipped = (
        load(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("game_no"))
        .agg(F.min("l_shipdate").alias("landed_at"))
    )
    path = F.format_string("/boxscores/%s/boxscore_%s.json", F.col("dt").cast("string"), F.col("game_id"))
    return game_keys(spark, sf_dir).join(shipped, "game_no").select("dt", path.alias("path"), "landed_at")
