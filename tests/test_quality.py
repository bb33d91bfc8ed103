import pytest

from leaguelake.operators import quality


def ids(spark, present, missing=0, repeated=0):
    values = [f"g{i}" for i in range(present)] + [None] * missing + ["g0"] * repeated
    return spark.createDataFrame([(v,) for v in values], "game_id string")


def test_schedule_gates_pass_at_exactly_the_allowed_loss(spark):
    assert quality.enforce(ids(spark, 80, missing=20), quality.schedule_gates()) is True


@pytest.mark.parametrize(
    "present, missing, repeated, gate",
    [(79, 21, 0, "schedule_loss"), (0, 3, 0, "schedule_not_empty"), (0, 0, 0, "schedule_not_empty"),
     (10, 0, 1, "schedule_ids_unique")],
)
def test_schedule_gates_stop(spark, present, missing, repeated, gate):
    with pytest.raises(quality.GateFailed, match=gate):
        quality.enforce(ids(spark, present, missing, repeated), quality.schedule_gates())


def test_boxscore_gates(spark):
    kind = "dt string, home_score int, away_score int"
    assert quality.enforce(spark.createDataFrame([("d", None, 3)], kind), quality.boxscore_gates())
    with pytest.raises(quality.GateFailed, match="boxscore_scores dt=d2"):
        quality.enforce(
            spark.createDataFrame([("d1", 5, 3), ("d2", -1, 3)], kind), quality.boxscore_gates(), by=["dt"]
        )
    with pytest.raises(quality.GateFailed, match="not_empty"):
        quality.enforce(spark.createDataFrame([], kind), quality.boxscore_gates())


def test_empty_player_lines_skip_without_error(spark):
    assert quality.enforce(spark.createDataFrame([], "game_id string"), quality.player_gates()) is False


SCHEDULE = "game_id string, game_type string, game_status int"
BOX = "game_id string, is_final boolean, home_score int, away_score int, winner string"
FACT = (
    "game_id string, player_id bigint, side string, pts int, fgm int, fga int, tpm int, tpa int, ftm int, fta int, "
    "fg_pct double, tp_pct double, ft_pct double"
)


def fact(game, player, side, pts=10, fgm=1, fga=2, fg_pct=0.5):
    return (game, player, side, pts, fgm, fga, 0, 0, 0, 0, fg_pct, None, 0.0)


def clean():
    return {
        "schedule": [("g1", "regular", 3), ("g2", "preseason", 1)],
        "boxes": [("g1", True, 100, 90, "home")],
        "facts": [fact("g1", 1, "home"), fact("g1", 2, "away")],
        "players": [(1,), (2,)],
    }


def counts(spark, data):
    report = quality.contract_suite(
        spark.createDataFrame(data["schedule"], SCHEDULE),
        spark.createDataFrame(data["boxes"], BOX),
        spark.createDataFrame(data["facts"], FACT),
        spark.createDataFrame(data["players"], "player_id bigint"),
    ).collect()
    assert {r.check_name: r.kind for r in report} == quality.CONTRACTS
    return {r.check_name: r.violations for r in report}


def test_clean_tables_have_no_violation(spark):
    assert set(counts(spark, clean()).values()) == {0}


PLANTED = {
    "boxscore_game_in_schedule": ("boxes", ("gX", False, 1, 2, "away")),
    "player_stats_game_in_schedule": ("facts", fact("gX", 1, "home")),
    "player_stats_player_in_dim": ("facts", fact("g1", 99, "home")),
    "final_game_has_boxscore": ("schedule", ("g9", "regular", 3)),
    "final_game_has_player_stats": ("boxes", ("g2", True, 100, 90, "home")),
    "game_has_two_sides": ("facts", fact("g2", 1, "home")),
    "scores_not_negative": ("boxes", ("g2", False, -1, 90, "away")),
    "final_scores_plausible": ("boxes", ("g3", True, 59, 90, "away")),
    "winner_domain": ("boxes", ("g2", False, 80, 80, "data_anomaly")),
    "game_type_domain": ("schedule", ("g9", "cup", 1)),
    "side_domain": ("facts", fact("g1", 1, "bench")),
    "percentages_in_range": ("facts", fact("g1", 2, "home", fg_pct=1.01)),
    "points_not_negative": ("facts", fact("g1", 2, "home", pts=-1)),
    "winner_matches_score": ("boxes", ("g2", True, 100, 90, "away")),
    "player_stats_key_unique": ("facts", fact("g1", 1, "home")),
    "made_within_attempted": ("facts", fact("g1", 2, "home", fgm=3, fga=2)),
}


@pytest.mark.parametrize("name", sorted(quality.CONTRACTS))
def test_planted_violation_is_found(spark, name):
    table, row = PLANTED[name]
    data = clean()
    data["schedule"].append(("g3", "playoff", 1))
    data[table].append(row)
    assert counts(spark, data)[name] == 1


def test_null_values_are_not_violations(spark):
    data = clean()
    data["boxes"].append(("g2", None, None, None, None))
    data["schedule"].append(("g4", "playoff", None))
    assert set(counts(spark, data).values()) == {0}


def test_preseason_scores_may_be_low(spark):
    data = clean()
    data["boxes"].append(("g2", True, 20, 10, "home"))
    data["facts"] += [fact("g2", 1, "home"), fact("g2", 2, "away")]
    assert counts(spark, data)["final_scores_plausible"] == 0


def test_gate_report_lists_every_gate(spark):
    report = quality.gate_report(ids(spark, 5), quality.schedule_gates()).orderBy("gate").collect()
    assert [(r.gate, r.passed) for r in report] == [
        ("schedule_ids_unique", True), ("schedule_loss", True), ("schedule_not_empty", True),
    ]
