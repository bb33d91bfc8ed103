"""Drift of documents from their read schema, against a plain walk over the parsed documents."""

import datetime as dt
import json
import random

import pytest
from league_files import boxscore, game, land, schedule
from pyspark.sql.types import ArrayType, StructType

from leaguelake import schemas
from leaguelake.plans import medallion
from leaguelake.sources import drift

DAY = "01/01/2026 00:00:00"


def found(df):
    return sorted((tuple(r) for r in df.select("path", "problem", "found", "documents", "occurrences").collect()), key=str)


def frame(spark, docs):
    return spark.createDataFrame([(d,) for d in docs], "doc string")


def name_of(value):
    if isinstance(value, bool):
        return "BOOLEAN"
    return {dict: "OBJECT", list: "ARRAY", str: "STRING", int: "BIGINT", type(None): "VOID"}[type(value)]


def walk(value, kind, path, any_shape):
    """(path, problem, found) of every drift in a parsed document."""
    if value is None:
        return
    if isinstance(kind, StructType):
        if not isinstance(value, dict):
            yield path, "retyped", name_of(value)
            return
        fields = {f.name: f.dataType for f in kind.fields}
        for key, inner in value.items():
            at = f"{path}.{key}".lstrip(".")
            if key in fields:
                yield from walk(inner, fields[key], at, any_shape)
            else:
                yield at, "unknown", name_of(inner)
    elif isinstance(kind, ArrayType):
        if not isinstance(value, list):
            yield path, "retyped", name_of(value)
            return
        for inner in value:
            yield from walk(inner, kind.elementType, f"{path}[]", any_shape)
    elif isinstance(value, (dict, list)) and path not in any_shape:
        yield path, "retyped", name_of(value)


def expected(docs, schema, any_shape=()):
    out = {}
    for doc in docs:
        try:
            finds = list(walk(json.loads(doc), schema, "", any_shape)) if doc and doc.strip() else [("", "unreadable", None)]
        except ValueError:
            finds = [("", "unreadable", None)]
        for find in set(finds):
            documents, times = out.get(find, (0, 0))
            out[find] = documents + 1, times + finds.count(find)
    return sorted(((*k, *v) for k, v in out.items()), key=str)


def test_known_paths():
    paths = drift.known_paths(schemas.BOXSCORE_DOCUMENT)
    assert paths[""] == "OBJECT" and paths["game.homeTeam.players"] == "ARRAY" and paths["game.homeTeam.players[].statistics.points"] == "LEAF"


@pytest.mark.parametrize("schema, any_shape", [(schemas.BOXSCORE_DOCUMENT, ()), (schemas.SCHEDULE_DOCUMENT, schemas.ANY_SHAPE)])
def test_random_documents(spark, schema, any_shape):
    rng = random.Random(4)
    names = ["game", "gameId", "gameStatus", "homeTeam", "players", "statistics", "points", "leagueSchedule", "gameDates", "games", "broadcasters", "nationalTvBroadcasters", "new"]

    def value(depth):
        kind = rng.randrange(6) if depth else rng.randrange(3)
        if kind < 3:
            return rng.choice([None, 1, "x", True, ""])
        if kind == 3:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {n: value(depth - 1) for n in rng.sample(names, rng.randrange(5))}

    def shaken(node):
        """A feed document with some values replaced and some fields added."""
        if rng.random() < 0.03:
            return value(3)
        if isinstance(node, dict):
            out = {k: shaken(v) for k, v in node.items() if rng.random() > 0.02}
            return out | ({"new": value(1)} if rng.random() < 0.1 else {})
        return [shaken(v) for v in node] if isinstance(node, list) else node if not isinstance(node, float) else 1

    docs = [json.dumps(value(6)) for _ in range(150)]
    docs += [json.dumps(shaken(boxscore("0022500001"))) for _ in range(100)]
    docs += [json.dumps(shaken(schedule([(DAY, [game("0022500001"), game("0022500002")])]))) for _ in range(100)]
    docs += docs[:20] + [d[: len(d) // 2] for d in docs[150:170]] + [None, "", "  ", "null", "[]", "{}", '"x"', "<html>"]
    assert found(drift.drift(frame(spark, docs), schema, any_shape=any_shape)) == expected(docs, schema, any_shape)


def test_nothing_to_report(spark):
    assert found(drift.drift(frame(spark, []), schemas.BOXSCORE_DOCUMENT)) == []
    doc = json.dumps({"game": {"gameId": "1", "gameStatus": None, "homeTeam": None, "awayTeam": {"score": "7", "players": [None, {}]}}})
    assert found(drift.drift(frame(spark, [doc] * 3), schemas.BOXSCORE_DOCUMENT)) == []


def test_one_parse_and_no_join(spark):
    plan = drift.drift(frame(spark, ["{}"]), schemas.BOXSCORE_DOCUMENT)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan") == 1


def test_lake(spark, tmp_path):
    lake = medallion.Lake(str(tmp_path), min_games=1)
    assert found(medallion.drift_report(spark, lake, "boxscores")) == []
    land(tmp_path / "bronze/boxscores/2026-01-01/boxscore_1.json", boxscore("0022500001"))
    land(tmp_path / "bronze/boxscores/2026-01-02/boxscore_2.json", dict(boxscore("0022500002"), rules={"shotClock": 24}))
    land(tmp_path / "bronze/schedule/2026-01-01/s.json", schedule([(DAY, [game("0022500001", broadcasters={"nationalTvBroadcasters": "ESPN", "intlTvBroadcasters": 7})])]))
    every = found(medallion.drift_report(spark, lake, "boxscores"))
    assert ("rules", "unknown", "OBJECT", 1, 1) in every and ("meta", "unknown", "OBJECT", 2, 2) in every
    assert ("meta", "unknown", "OBJECT", 1, 1) in found(medallion.drift_report(spark, lake, "boxscores", since=dt.date(2026, 1, 2)))
    assert found(medallion.drift_report(spark, lake, "schedule")) == [("leagueSchedule.seasonYear", "unknown", "STRING", 1, 1)]


def test_lines(spark, tmp_path):
    lake = medallion.Lake(str(tmp_path), multi_line=False)
    path = tmp_path / "bronze/boxscores/2026-01-01/all.json"
    path.parent.mkdir(parents=True)
    docs = ['{"game": {"period": 4}}', '{"game": {"per', '{"game": {}}', '{"game": {"period": 4}}']
    path.write_text("\n".join([docs[0], "", *docs[1:], " "]), encoding="utf-8")
    assert found(medallion.drift_report(spark, lake, "boxscores")) == expected(docs, schemas.BOXSCORE_DOCUMENT)
