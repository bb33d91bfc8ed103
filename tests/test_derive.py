import datetime as dt

import pytest
from pyspark.sql import functions as F

from leaguelake.functions import derive, localtime, text


def one(spark, column, **values):
    kinds = {str: "string", int: "int", float: "double", dt.datetime: "timestamp_ntz", type(None): "string", bool: "boolean"}
    row = spark.range(1).select(*[F.lit(v).cast(kinds[type(v)]).alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "game_id, expected",
    [
        ("0022500001", "regular"), ("0042500001", "playoff"), ("0052500001", "play-in"), ("0012500001", "preseason"),
        ("0032500001", "preseason"), ("", "preseason"), (None, "preseason"), ("002", "regular"),
    ],
)
def test_game_type(spark, game_id, expected):
    assert one(spark, derive.game_type(F.col("x")), x=game_id) == expected


SERIES = [
    ("BOS leads 3-1", 3, 1), ("NYK leads 3-1", 1, 3), ("Series tied 2-2", 2, 2), ("BOS wins 4-2", 4, 2),
    ("", None, None), (None, None, None), ("BOS vs NYK", None, None), ("Series tied 2-1", 2, 2),
    (" BOS leads 1-0", 1, 1), ("LAL leads 2-0", None, None), ("ÉTÉ leads 2-0", None, None),
    ("BOS leads 3-1 (was 2-1)", 3, 1),
]


def test_series_wins(spark):
    df = spark.createDataFrame([(s[0],) for s in SERIES], "label string")
    out = derive.with_series_wins(df, F.col("label"), F.lit("BOS"), F.lit("NYK")).collect()
    assert [(r.label, r.home_series_wins, r.away_series_wins) for r in out] == SERIES


def test_series_leader_outside_ascii(spark):
    df = spark.createDataFrame([("ÉTÉ leads 2-0",)], "label string")
    row = derive.with_series_wins(df, F.col("label"), F.lit("BOS"), F.lit("ÉTÉ")).first()
    assert (row.home_series_wins, row.away_series_wins) == (0, 2)


def test_series_without_codes_never_matches(spark):
    df = spark.createDataFrame([("BOS leads 3-1",)], "label string")
    none = F.lit(None).cast("string")
    row = derive.with_series_wins(df, F.col("label"), none, none).first()
    assert (row.home_series_wins, row.away_series_wins) == (None, None)


def test_team_codes(spark):
    assert one(spark, derive.away_code(F.col("x")), x="20260101/NYKBOS") == "NYK"
    assert one(spark, derive.home_code(F.col("x")), x="20260101/NYKBOS") == "BOS"
    assert one(spark, derive.home_code(F.col("x")), x="20260101") is None


@pytest.mark.parametrize(
    "raw, expected",
    [
        ('[{"broadcasterDisplay":"ESPN","id":1},{"broadcasterDisplay":"TNT"}]', "ESPN"),
        ('["{\\"broadcasterDisplay\\":\\"ESPN\\"}"]', "ESPN"),
        ("[]", None), ("", None), (None, None), ("ESPN", None),
    ],
)
def test_first_broadcaster(spark, raw, expected):
    assert one(spark, derive.first_broadcaster(F.col("x")), x=raw) == expected


@pytest.mark.parametrize("home, away, expected", [(100, 90, "home"), (90, 100, "away"), (90, 90, "data_anomaly")])
def test_winner(spark, home, away, expected):
    assert one(spark, derive.winner(F.col("a"), F.col("h")), h=home, a=away) == expected


def test_winner_without_score(spark):
    assert one(spark, derive.winner(F.lit(None).cast("int"), F.lit(3))) == "data_anomaly"


@pytest.mark.parametrize("raw, expected", [("3", 3), ("12.0", 12), ("x", None), ("true", 1), (None, None), ("-4.9", -4)])
def test_as_int(spark, raw, expected):
    assert one(spark, derive.as_int(F.col("x")), x=raw) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_utc_instant_ignores_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, derive.utc_instant(F.col("x")), x="2026-01-01T00:30:00Z") == dt.datetime(2026, 1, 1, 0, 30)
        assert one(spark, derive.utc_instant(F.col("x")), x="yesterday") is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar_day(spark):
    assert one(spark, derive.calendar_day(F.col("x")), x="10/21/2025 00:00:00") == dt.date(2025, 10, 21)
    assert one(spark, derive.calendar_day(F.col("x")), x="TBD") is None


@pytest.mark.parametrize("raw, expected", [("1", True), ("0", False), ("true", True), (None, False), ("2", False)])
def test_truthy(spark, raw, expected):
    assert one(spark, derive.truthy(F.col("x")), x=raw) is expected


def test_surrogate_key(spark):
    assert one(spark, derive.surrogate_key(F.col("g"), F.col("p")), g="0022500001", p=7) == "0022500001_7"
    assert one(spark, derive.surrogate_key(F.col("g"), F.lit(None).cast("bigint")), g="0022500001") is None


@pytest.mark.parametrize("raw, expected", [("PT34M12.00S", 34), ("34:12", 34), ("", None), ("DNP", None), (None, None)])
def test_minutes_played(spark, raw, expected):
    assert one(spark, derive.minutes_played(F.col("x")), x=raw) == expected


def test_late_game_belongs_to_local_day_before(spark):
    late = dt.datetime(2026, 1, 2, 2, 0)
    assert one(spark, localtime.local_date(F.col("x")), x=late) == dt.date(2026, 1, 1)
    assert one(spark, localtime.on_local_date(F.col("x"), dt.date(2026, 1, 1)), x=late) is True
    assert one(spark, localtime.on_local_date(F.col("x"), dt.date(2026, 1, 2)), x=late) is False


def test_poll_question(spark):
    at = dt.datetime(2026, 1, 1, 21, 30)
    question = text.poll_question(F.col("t"), F.col("b"))
    assert one(spark, question, t=at, b="TV Sul") == "21h30 — TV Sul"
    assert one(spark, question, t=at, b="") == "21h30"
    assert one(spark, question, t=at, b=None) == "21h30"


def test_poll_options(spark):
    row = spark.createDataFrame(
        [("playoff", 3, 1), ("playoff", None, None), ("regular", 3, 1)], "kind string, hw int, aw int"
    ).selectExpr(
        "*", "'Boston' home_team_city", "'Celtics' home_team_name", "'New York' away_team_city", "'Knicks' away_team_name"
    )
    away, home = text.poll_options(F.col("kind"), F.col("hw"), F.col("aw"))
    assert [tuple(r) for r in row.select(away, home).collect()] == [
        ("New York Knicks 2x3", "Boston Celtics 4x1"),
        ("New York Knicks", "Boston Celtics"),
        ("New York Knicks", "Boston Celtics"),
    ]
