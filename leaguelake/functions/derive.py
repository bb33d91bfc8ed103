"""Derivations as native column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# fixed values of the feed
FINAL_STATUS = 3
GAME_TYPE_BY_PREFIX = {"002": "regular", "004": "playoff", "005": "play-in"}
OTHER_GAME_TYPE = "preseason"
GAME_TYPES = ("regular", "playoff", "play-in", "preseason")
SCORE_PATTERN = r"(?U)(\d+)-(\d+)"
LEADER_PATTERN = r"(?U)^(\w+)\s+(leads|wins)"


def as_int(value: Column) -> Column:
    """Text to int; ``12.0`` becomes 12, a boolean 1 or 0, anything unreadable NULL."""
    return (
        F.when(value == "true", F.lit(1))
        .when(value == "false", F.lit(0))
        .otherwise(value.try_cast("double").try_cast("int"))
    )


def _matched_int(text: Column, pattern: str, group: int) -> Column:
    """A group of a pattern as int, NULL without a match. No match is NULL before the cast: a cast of empty text
    raises an error inside ``try_cast``, which costs ten times the match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast("int")


def utc_instant(text: Column) -> Column:
    """ISO instant with zone designator to a zone-free UTC timestamp, whatever the session zone."""
    instant = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=F.unix_timestamp(instant).cast("decimal(18,6)"))


def calendar_day(text: Column) -> Column:
    """Date part of a ``MM/dd/yyyy HH:mm:ss`` label; unreadable labels give NULL."""
    return F.try_to_timestamp(F.split_part(text, F.lit(" "), F.lit(1)), F.lit("M/d/yyyy")).cast("date")


def game_type(game_id: Column) -> Column:
    prefix = F.substring(game_id, 1, 3)
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for code, name in GAME_TYPE_BY_PREFIX.items():
        label = label.when(prefix == code, name)
    return label.otherwise(OTHER_GAME_TYPE)


def away_code(game_code: Column) -> Column:
    return F.substring(F.nullif(F.split_part(game_code, F.lit("/"), F.lit(2)), F.lit("")), 1, 3)


def home_code(game_code: Column) -> Column:
    return F.substring(F.nullif(F.split_part(game_code, F.lit("/"), F.lit(2)), F.lit("")), 4, 3)


def with_series_wins(df: DataFrame, text: Column, home: Column, away: Column) -> DataFrame:
    """Add ``home_series_wins`` and ``away_series_wins`` read from a series label.

    Both are NULL when the label names no known standing. A label without a leader is a tie, so both sides get
    the first number. Each pattern is matched once per row: the parts are columns of their own before the
    choice between them.
    """
    parts = df.withColumns(
        {
            "_first": _matched_int(text, SCORE_PATTERN, 1),
            "_second": _matched_int(text, SCORE_PATTERN, 2),
            "_leader": F.regexp_extract(text, LEADER_PATTERN, 1),
            "_home": home,
            "_away": away,
        }
    )
    first, second, leader = F.col("_first"), F.col("_second"), F.col("_leader")
    tied, home_leads, away_leads = leader == "", leader == F.col("_home"), leader == F.col("_away")
    return parts.withColumns(
        {
            "home_series_wins": F.when(tied | home_leads, first).when(away_leads, second),
            "away_series_wins": F.when(tied, first).when(home_leads, second).when(away_leads, first),
        }
    ).drop("_first", "_second", "_leader", "_home", "_away")


def is_final(status: Column) -> Column:
    return status == FINAL_STATUS


def winner(away_score: Column, home_score: Column) -> Column:
    return (
        F.when(away_score > home_score, "away").when(home_score > away_score, "home").otherwise("data_anomaly")
    )


def first_broadcaster(raw: Column) -> Column:
    """Display name of the first broadcaster; the raw text may be a list of objects, of texts, or a text."""
    return F.coalesce(
        F.get_json_object(raw, "$[0].broadcasterDisplay"),
        F.get_json_object(F.get_json_object(raw, "$[0]"), "$.broadcasterDisplay"),
    )


def truthy(value: Column) -> Column:
    return F.coalesce(F.lower(value.cast("string")).isin("1", "true"), F.lit(False))


def surrogate_key(*parts: Column) -> Column:
    """Parts joined by ``_``; NULL when any part is NULL."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("_"), part.cast("string")]
    return F.concat(*pieces)


def minutes_played(text: Column) -> Column:
    """Whole minutes from ``PT34M12.00S`` or ``34:12``; anything else NULL."""
    iso = _matched_int(text, r"^PT(\d+)M([\d.]+)S$", 1)
    clock = _matched_int(text, r"^(\d+):(\d{2})$", 1)
    return F.coalesce(iso, clock)
