"""SQL twins of the registered queries, over the given tables (DuckDB dialect).

Each text starts from the base tables and never from an output of ours. Constants repeat the parameters of
``plans.catalog`` and ``sources.bridge``.
"""

from __future__ import annotations

GAME_TYPE = """CASE substr(game_id, 1, 3)
    WHEN '002' THEN 'regular' WHEN '004' THEN 'playoff' WHEN '005' THEN 'play-in' ELSE 'preseason' END"""

CTES = {
    "keys": f"""keys AS (
  SELECT o_orderkey AS k, o_custkey,
    '00' || substr(o_orderpriority, 1, 1)
      || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(7, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS game_id,
    CAST(o_orderdate AS DATE) AS dt,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS ts,
    CAST(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'P' THEN 2 WHEN 'O' THEN 1 END AS INTEGER) AS status,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, o_totalprice < 5000 AS called_off
  FROM orders)""",
    "typed": f"""typed AS (SELECT *, {GAME_TYPE} AS game_type FROM keys)""",
    "teams": """teams AS (
  SELECT n_nationkey AS id, n_name AS name, r_name AS city,
    'T' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)""",
    "games": """games AS (
  SELECT t.*, h.id AS home_id, h.name AS home_name, h.city AS home_city, h.code AS home_code,
    a.id AS away_id, a.name AS away_name, a.city AS away_city, a.code AS away_code,
    CASE WHEN t.k % 4 <> 3 THEN h.city END AS us_broadcaster,
    CASE WHEN (t.k + 1) % 4 <> 3 THEN a.city END AS brazil_broadcaster,
    CASE t.k % 6 WHEN 0 THEN h.code || ' leads 3-1' WHEN 1 THEN a.code || ' wins 4-2' WHEN 2 THEN 'Series tied 2-2'
      WHEN 3 THEN '' WHEN 5 THEN h.code || ' vs ' || a.code END AS series_text
  FROM typed t LEFT JOIN customer c ON t.o_custkey = c.c_custkey
  LEFT JOIN teams h ON h.id = c.c_nationkey
  LEFT JOIN teams a ON a.id = (c.c_nationkey + 1 + t.k % 24) % 25)""",
    "parsed": r"""parsed AS (
  SELECT *, TRY_CAST(regexp_extract(series_text, '(\d+)-(\d+)', 1) AS INTEGER) AS a,
    TRY_CAST(regexp_extract(series_text, '(\d+)-(\d+)', 2) AS INTEGER) AS b,
    regexp_extract(series_text, '^(\w+)\s+(leads|wins)', 1) AS leader
  FROM games)""",
    "series": """series AS (
  SELECT *, CASE WHEN leader = '' OR leader = home_code THEN a WHEN leader = away_code THEN b END AS hw,
    CASE WHEN leader = '' OR leader = away_code THEN a WHEN leader = home_code THEN b END AS aw
  FROM parsed)""",
    "schedule": """schedule AS (
  SELECT k, dt, game_id, ts AS game_datetime_utc, status AS game_status, game_type,
    home_city AS home_team_city, home_name AS home_team_name, away_city AS away_team_city, away_name AS away_team_name,
    us_broadcaster, brazil_broadcaster,
    CASE WHEN game_type = 'playoff' THEN hw END AS home_series_wins,
    CASE WHEN game_type = 'playoff' THEN aw END AS away_series_wins
  FROM series)""",
    "lines": """lines AS (
  SELECT l_orderkey AS k, CASE l_linestatus WHEN 'O' THEN 'home' ELSE 'away' END AS side,
    l_suppkey AS player_id, l_partkey AS part_id, l_returnflag <> 'N' AS played,
    CAST(CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END AS INTEGER) AS starter,
    CASE l_linenumber % 3
      WHEN 0 THEN 'PT' || CAST(l_quantity AS INTEGER) || 'M' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || '.00S'
      WHEN 1 THEN CAST(l_quantity AS INTEGER) || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0')
      ELSE '' END AS minutes,
    CASE l_linenumber % 3 WHEN 2 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS mins,
    CAST(l_quantity AS INTEGER) AS pts, l_linenumber AS reb, CAST(l_partkey % 10 AS INTEGER) AS ast,
    CAST(l_suppkey % 5 AS INTEGER) AS stl, CAST(l_partkey % 4 AS INTEGER) AS blk,
    CAST((l_partkey + l_suppkey) % 6 AS INTEGER) AS tov, CAST(l_quantity AS INTEGER) - 25 AS plus_minus,
    CAST(l_quantity AS INTEGER) AS fgm, CAST(l_quantity AS INTEGER) + l_linenumber AS fga, l_discount AS fg_pct,
    CAST(l_partkey % 5 AS INTEGER) AS tpm, CAST(l_partkey % 5 + l_linenumber AS INTEGER) AS tpa, l_tax AS tp_pct,
    CAST(l_suppkey % 7 AS INTEGER) AS ftm, CAST(l_suppkey % 7 + l_partkey % 3 AS INTEGER) AS fta,
    l_discount + l_tax AS ft_pct, CAST(l_linenumber % 3 AS INTEGER) AS reb_off,
    CAST(l_linenumber - l_linenumber % 3 AS INTEGER) AS reb_def
  FROM lineitem)""",
    "scores": """scores AS (
  SELECT k, CAST(SUM(CASE WHEN side = 'home' THEN pts END) AS INTEGER) AS home_score,
    CAST(SUM(CASE WHEN side = 'away' THEN pts END) AS INTEGER) AS away_score
  FROM lines GROUP BY k)""",
    "boxes": """boxes AS (
  SELECT t.*, s.home_score, s.away_score, t.status = 3 AS is_final,
    CASE WHEN away_score > home_score THEN 'away' WHEN home_score > away_score THEN 'home' ELSE 'data_anomaly' END AS winner
  FROM typed t JOIN scores s ON t.k = s.k)""",
    "stats": """stats AS (
  SELECT l.*, t.game_id, t.dt, t.ts FROM lines l JOIN typed t ON l.k = t.k WHERE l.played)""",
    "facts": """facts AS (
  SELECT *, game_id || '_' || player_id AS pk FROM stats
  QUALIFY row_number() OVER (PARTITION BY game_id, player_id ORDER BY dt DESC, side DESC, starter NULLS FIRST,
    minutes NULLS FIRST, pts, reb, ast, stl, blk, tov, plus_minus, fgm, fga, fg_pct, tpm, tpa, tp_pct, ftm, fta, ft_pct,
    reb_off, reb_def) = 1)""",
    "players": """players AS (
  SELECT player_id, s_name AS player_name, p_type AS position
  FROM stats LEFT JOIN supplier ON player_id = s_suppkey LEFT JOIN part ON part_id = p_partkey
  QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY dt DESC, side DESC, game_id,
    s_name NULLS FIRST, p_type NULLS FIRST) = 1)""",
    "first_day": """first_day AS (SELECT *, DATE '2026-01-01' AS snapshot FROM keys)""",
    "second_day": """second_day AS (
  SELECT * REPLACE (CAST(CASE WHEN status = 2 THEN 3 ELSE status END AS INTEGER) AS status), DATE '2026-01-02' AS snapshot
  FROM keys WHERE NOT called_off)""",
    "newest": """newest AS (
  SELECT f.* REPLACE (COALESCE(s.status, f.status) AS status, COALESCE(s.snapshot, f.snapshot) AS snapshot)
  FROM first_day f LEFT JOIN second_day s ON f.k = s.k)""",
    "landed": """landed AS (
  SELECT l_orderkey AS k, MIN(l_shipdate) AS landed_at FROM lineitem GROUP BY l_orderkey)""",
    "finished": """finished AS (SELECT * FROM keys WHERE status = 3)""",
}

NEEDS = {
    "typed": ["keys"], "games": ["typed", "teams"], "parsed": ["games"], "series": ["parsed"],
    "schedule": ["series"], "scores": ["lines"], "boxes": ["typed", "scores"], "stats": ["lines", "typed"],
    "facts": ["stats"], "players": ["stats"], "first_day": ["keys"], "second_day": ["keys"],
    "newest": ["first_day", "second_day"], "finished": ["keys"],
}


def _with(names: str, body: str) -> str:
    """``body`` preceded by the named common table expressions and those they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ",\n".join(CTES[n] for n in ordered) + "\n" + body.strip()


def local(ts: str) -> str:
    return f"(({ts} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo')"


SCHEDULE_COLUMNS = """game_id, game_datetime_utc, game_status, game_type, home_team_city, home_team_name,
    away_team_city, away_team_name, us_broadcaster, brazil_broadcaster, home_series_wins, away_series_wins"""
STAT_COLUMNS = """minutes, pts, reb, ast, stl, blk, tov, plus_minus, fgm, fga, fg_pct, tpm, tpa, tp_pct, ftm, fta, ft_pct,
    reb_off, reb_def"""
TEAM_COLUMNS = """CAST(CASE s.side WHEN 'home' THEN g.home_id ELSE g.away_id END AS BIGINT) AS team_id,
    CASE s.side WHEN 'home' THEN g.home_city ELSE g.away_city END AS team_city,
    CASE s.side WHEN 'home' THEN g.home_name ELSE g.away_name END AS team_name"""

# the flag that a snapshot gives; NULL where it says nothing
CANCELLED = """CASE WHEN s.game_type = 'playoff' AND {status} <> 3
    THEN {gone} OR COALESCE(s.home_series_wins >= 4, FALSE) OR COALESCE(s.away_series_wins >= 4, FALSE)
    WHEN NOT {gone} THEN FALSE END"""

RESULTS = f"""
, results AS (
  SELECT CAST({local('ts')} AS DATE) AS local_date, ts AS game_datetime_utc, game_id,
    COALESCE(away_name, '-') || CASE WHEN away_score > home_score THEN ' ✅' ELSE '' END || ' *'
      || COALESCE(CAST(away_score AS VARCHAR), '-') || '*  x  *' || COALESCE(CAST(home_score AS VARCHAR), '-') || '* '
      || COALESCE(home_name, '-') || CASE WHEN home_score > away_score THEN ' ✅' ELSE '' END AS line
  FROM games g JOIN scores s ON g.k = s.k WHERE status = 3)"""
DIGEST = _with("games scores", RESULTS + "\nSELECT * FROM results")


def _contracts(schedule: str, boxes: str, facts: str, players: str) -> str:
    """Counts of broken rules: every table is read once for its own rules, and once for each rule that needs another table."""

    def outside(table: str, key: str, other: str, test: str = "TRUE") -> str:
        return f"(SELECT COUNT(*) FROM {table} x WHERE ({test}) AND NOT EXISTS (FROM {other} y WHERE y.{key} = x.{key}))"

    shares = " OR ".join(f"{c} NOT BETWEEN 0 AND 1" for c in ("fg_pct", "tp_pct", "ft_pct"))
    made = " OR ".join(f"{a}m > {a}a" for a in ("fg", "tp", "ft"))
    better = "CASE sign(home_score - away_score) WHEN 1 THEN 'home' WHEN -1 THEN 'away' END"
    rules = {
        "boxscore_game_in_schedule": ("referential", outside("boxed", "game_id", "listed")),
        "player_stats_game_in_schedule": ("referential", outside("stat_lines", "game_id", "listed")),
        "player_stats_player_in_dim": ("referential", outside("stat_lines", "player_id", "known")),
        "final_game_has_boxscore": ("completeness", outside("listed", "game_id", "boxed", "game_status = 3")),
        "final_game_has_player_stats": ("completeness", outside("boxed", "game_id", "stat_lines", "is_final")),
        "game_has_two_sides": ("cardinality", "(SELECT COUNT(*) FILTER (sides <> 2) FROM by_game)"),
        "scores_not_negative": ("row", "(SELECT COUNT(*) FILTER (least(home_score, away_score) < 0) FROM boxed)"),
        "final_scores_plausible": (
            "joined row",
            "(SELECT COUNT(*) FROM boxed WHERE is_final AND least(home_score, away_score) < 60 AND game_id IN "
            "(SELECT game_id FROM listed WHERE list_contains(['regular', 'playoff', 'play-in'], game_type)))",
        ),
        "winner_domain": ("domain", "(SELECT COUNT(winner) FILTER (NOT list_contains(['home', 'away'], winner)) FROM boxed)"),
        "game_type_domain": (
            "domain",
            "(SELECT COUNT(game_type) FILTER (NOT list_contains(['regular', 'playoff', 'play-in', 'preseason'], game_type)) FROM listed)",
        ),
        "side_domain": ("domain", "(SELECT COUNT(side) FILTER (NOT list_contains(['home', 'away'], side)) FROM stat_lines)"),
        "percentages_in_range": ("range", f"(SELECT COUNT(*) FILTER ({shares}) FROM stat_lines)"),
        "points_not_negative": ("range", "(SELECT COUNT(*) FILTER (sign(pts) = -1) FROM stat_lines)"),
        "winner_matches_score": ("cross-column", f"(SELECT COUNT(*) FILTER (is_final AND winner <> {better}) FROM boxed)"),
        "player_stats_key_unique": ("key", "(SELECT COUNT(*) FILTER (copies > 1) FROM by_line)"),
        "made_within_attempted": ("cross-column", f"(SELECT COUNT(*) FILTER ({made}) FROM stat_lines)"),
    }
    rows = ",\n".join(f"('{name}', '{kind}', {count})" for name, (kind, count) in rules.items())
    return _with("facts boxes", f""",
listed AS ({schedule}), boxed AS ({boxes}), stat_lines AS ({facts}), known AS ({players}),
by_game AS (SELECT game_id, COUNT(DISTINCT side) AS sides FROM stat_lines GROUP BY game_id),
by_line AS (SELECT COUNT(*) AS copies FROM stat_lines GROUP BY game_id, player_id)
SELECT rule AS check_name, kind, CAST(broken AS BIGINT) AS violations
FROM (VALUES {rows}) AS counted(rule, kind, broken)""")


PLANTED_CONTRACTS = _contracts(
    "SELECT CASE WHEN k % 89 = 0 THEN 'X' || game_id ELSE game_id END AS game_id, status AS game_status, "
    "CASE WHEN k % 83 = 0 THEN 'exhibition' ELSE game_type END AS game_type FROM typed",
    "SELECT * REPLACE (CASE WHEN k % 79 = 0 THEN 'X' || game_id ELSE game_id END AS game_id, "
    "CASE WHEN k % 73 = 0 THEN -home_score ELSE home_score END AS home_score, "
    "CASE WHEN k % 71 = 0 THEN 'away' ELSE winner END AS winner) FROM boxes",
    "SELECT * REPLACE (CASE WHEN k % 67 = 0 THEN 'X' || game_id ELSE game_id END AS game_id, "
    "CASE WHEN (k + reb) % 61 = 0 THEN 'bench' ELSE side END AS side, "
    "CASE WHEN part_id % 59 = 0 THEN 1.5 ELSE fg_pct END AS fg_pct, "
    "CASE WHEN part_id % 53 = 0 THEN -pts ELSE pts END AS pts, "
    "CASE WHEN part_id % 47 = 0 THEN fga + 1 ELSE fgm END AS fgm) FROM stats",
    "SELECT CASE WHEN s_suppkey % 43 = 0 THEN -1 - s_suppkey ELSE s_suppkey END AS player_id FROM supplier",
)


SQL = {
    "schedule_flatten": _with("schedule", f"SELECT {SCHEDULE_COLUMNS} FROM schedule"),
    "schedule_broadcasters": _with("games", "SELECT game_id, us_broadcaster, brazil_broadcaster FROM games"),
    "game_type": _with("typed", "SELECT game_id, game_type FROM typed"),
    "series_wins": _with("series", """
SELECT game_id, hw AS parsed_home_wins, aw AS parsed_away_wins,
  CASE WHEN game_type = 'playoff' THEN hw END AS home_series_wins,
  CASE WHEN game_type = 'playoff' THEN aw END AS away_series_wins FROM series"""),
    "boxscore_silver": _with("games boxes", """
SELECT b.game_id, b.status AS game_status, g.away_city AS away_team_city, g.away_name AS away_team_name, b.away_score,
  g.home_city AS home_team_city, g.home_name AS home_team_name, b.home_score, b.is_final, b.winner
FROM boxes b JOIN games g ON b.k = g.k"""),
    "player_lines": _with("games stats", f"""
SELECT s.game_id, {TEAM_COLUMNS}, s.side, s.player_id, s_name AS player_name, p_type AS position, s.starter, {STAT_COLUMNS}
FROM stats s JOIN games g ON s.k = g.k
LEFT JOIN supplier ON s.player_id = s_suppkey LEFT JOIN part ON s.part_id = p_partkey"""),
    "wanted_manifest": _with("keys", "SELECT dt, game_id FROM keys"),
    "completed_manifest": _with("finished", "SELECT dt, game_id FROM finished"),
    "missing_games": _with("finished landed", """
SELECT dt, game_id FROM finished f WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.k = f.k)"""),
    "pending_dates": _with("keys", """
SELECT dt, NOT bool_or(status = 3) AS need_boxscores, NOT bool_or(status = 2) AS need_players
FROM keys GROUP BY dt HAVING NOT bool_or(status = 3) OR NOT bool_or(status = 2)"""),
    "ingest_audit": _with("finished landed", """
SELECT dt, CAST(COUNT(*) AS BIGINT) AS wanted,
  CAST(COUNT(*) FILTER (landed_at >= TIMESTAMP '1998-06-01') AS BIGINT) AS landed,
  CAST(COUNT(*) FILTER (landed_at < TIMESTAMP '1998-06-01') AS BIGINT) AS skipped,
  CAST(COUNT(*) FILTER (landed_at IS NULL) AS BIGINT) AS failed,
  COUNT(landed_at) = 0 AS none_landed
FROM finished f LEFT JOIN landed l ON f.k = l.k GROUP BY ROLLUP (dt)"""),
    "source_selection": _with("keys", """
, totals AS (
  SELECT 'feed_' || priority AS source, priority, CAST(COUNT(*) AS BIGINT) AS total_games FROM keys GROUP BY priority),
enough AS (SELECT COUNT(*) // 5 + 1 AS least_games FROM keys)
SELECT source, priority, total_games, total_games >= least_games AS accepted,
  COALESCE(priority = (SELECT MIN(priority) FROM totals, enough WHERE total_games >= least_games), FALSE) AS chosen
FROM totals, enough"""),
    "latest_snapshot": _with("second_day", "SELECT snapshot, game_id, status AS game_status FROM second_day"),
    "silver_gates": _with("typed scores", """
, ids AS (
  SELECT 'given' AS rows, game_id FROM typed UNION ALL
  SELECT 'planted', CASE WHEN k % 4 = 0 THEN NULL WHEN k % 97 = 0 THEN '0021' ELSE game_id END FROM typed),
starts AS (SELECT 'given' AS rows, FALSE AS bad FROM typed UNION ALL SELECT 'planted', status = 2 FROM typed),
marks AS (
  SELECT 'given' AS rows, least(home_score, away_score) AS low FROM scores UNION ALL
  SELECT 'planted', least(CASE WHEN k % 89 = 0 THEN -home_score ELSE home_score END, away_score) FROM scores),
counted AS (
  SELECT rows, COUNT(*) AS n, COUNT(game_id) AS kept, COUNT(DISTINCT game_id) AS ids FROM ids GROUP BY rows)
SELECT rows, 'schedule_not_empty' AS gate, 'fail' AS policy, kept > 0 AS passed FROM counted
UNION ALL SELECT rows, 'schedule_loss', 'fail', (n - kept) <= 0.2 * n FROM counted
UNION ALL SELECT rows, 'schedule_ids_unique', 'fail', ids = kept FROM counted
UNION ALL SELECT rows, 'schedule_status_typed', 'fail', TRUE FROM counted
UNION ALL SELECT rows, 'schedule_start_typed', 'fail', NOT bool_or(bad) FROM starts GROUP BY rows
UNION ALL SELECT rows, 'boxscores_not_empty', 'fail', COUNT(*) > 0 FROM marks GROUP BY rows
UNION ALL SELECT rows, 'boxscore_scores', 'fail', COUNT(*) FILTER (low < 0) = 0 FROM marks GROUP BY rows
UNION ALL SELECT 'given', 'player_lines_not_empty', 'skip', COUNT(*) FILTER (played) > 0 FROM lines
UNION ALL SELECT 'planted', 'player_lines_not_empty', 'skip', FALSE"""),
    "parameterised_read": _with("typed", f"""
SELECT CAST({local('ts')} AS DATE) AS run_date, game_id, game_type, status AS game_status FROM typed
WHERE CAST({local('ts')} AS DATE) IN (DATE '1997-03-15', DATE '2050-01-01') AND game_type <> 'preseason'"""),
    "dim_players": _with("players", "SELECT * FROM players"),
    "fact_player_game_stats": _with("games facts", f"""
SELECT s.game_id, {TEAM_COLUMNS}, s.side, s.player_id, s.starter = 1 AS starter, {STAT_COLUMNS}, s.pk
FROM facts s JOIN games g ON s.k = g.k"""),
    "upsert_schedule": _with("schedule second_day", f"""
SELECT s.* EXCLUDE (k, dt, game_status), COALESCE(n.status, s.game_status) AS game_status,
  CASE WHEN s.k % 3 = 0 THEN s.k * 10 END AS poll_message_id, FALSE AS is_cancelled
FROM schedule s LEFT JOIN second_day n ON s.k = n.k"""),
    "latest_wins": _with("newest", "SELECT game_id, status AS game_status, snapshot FROM newest"),
    "partition_overwrite": _with("first_day second_day", """
SELECT CAST(date_trunc('month', dt) AS DATE) AS month, game_id, status AS game_status, snapshot
FROM first_day WHERE dt < DATE '1998-01-01'
UNION ALL
SELECT CAST(date_trunc('month', dt) AS DATE), game_id, status, snapshot FROM second_day WHERE dt >= DATE '1998-01-01'"""),
    "pk_violations": _with("stats", """
SELECT game_id, player_id, CAST(COUNT(*) AS BIGINT) AS n_rows FROM stats GROUP BY game_id, player_id HAVING COUNT(*) > 1"""),
    "cancel_phantoms": _with("newest schedule", f"""
, judged AS (SELECT s.game_id, s.k % 50 = 0 AS was, {CANCELLED.format(status='n.status', gone='n.called_off')} AS flag
  FROM schedule s JOIN newest n ON s.k = n.k),
settled AS (SELECT game_id, was, COALESCE(flag, was) AS flag FROM judged)
SELECT game_id, flag AS is_cancelled, flag AND NOT was AS newly_cancelled FROM settled"""),
    "cancel_replay": _with("newest schedule", f"""
SELECT 1 AS step, game_id, COALESCE({CANCELLED.format(status='s.game_status', gone='FALSE')}, FALSE) AS is_cancelled FROM schedule s
UNION ALL
SELECT 2, s.game_id, COALESCE({CANCELLED.format(status='n.status', gone='n.called_off')}, FALSE)
FROM schedule s JOIN newest n ON s.k = n.k
UNION ALL
SELECT 3, game_id, COALESCE({CANCELLED.format(status='s.game_status', gone='FALSE')}, FALSE) FROM schedule s"""),
    "table_upsert": _with("first_day second_day", """
SELECT f.game_id, CAST(CASE WHEN s.k IS NULL THEN f.dt + 1 WHEN s.k % 10 = 0 THEN s.dt + 30 ELSE s.dt END AS DATE) AS dt,
  COALESCE(s.status, f.status) AS game_status,
  CAST(CASE WHEN s.k IS NULL THEN f.snapshot WHEN s.k % 10 = 0 THEN s.snapshot + 1 ELSE s.snapshot END AS DATE) AS snapshot,
  FALSE AS is_cancelled
FROM first_day f LEFT JOIN second_day s ON f.k = s.k"""),
    "file_scan_schedule": _with("schedule second_day", f"""
SELECT {SCHEDULE_COLUMNS}, DATE '2026-01-01' AS snapshot FROM schedule
UNION ALL
SELECT s.* EXCLUDE (k, dt) REPLACE (n.status AS game_status), DATE '2026-01-02'
FROM schedule s JOIN second_day n ON s.k = n.k"""),
    "file_scan_boxscores": _with("games stats", f"""
SELECT s.game_id, {TEAM_COLUMNS}, s.side, s.player_id, s_name AS player_name, p_type AS position, s.starter, {STAT_COLUMNS},
  DATE '2026-01-01' AS landed
FROM stats s JOIN games g ON s.k = g.k
LEFT JOIN supplier ON s.player_id = s_suppkey LEFT JOIN part ON s.part_id = p_partkey"""),
    "table_roundtrip": _with("schedule", f"""
SELECT {SCHEDULE_COLUMNS} FROM schedule WHERE dt IN (DATE '1997-03-15', DATE '2050-01-01')"""),
    "incremental_boxscores": _with("typed scores", """
, corrected AS (
  SELECT game_id, CAST('1' || home_score AS INTEGER) AS home_score, CAST('1' || away_score AS INTEGER) AS away_score
  FROM typed t JOIN scores s ON t.k = s.k)
SELECT *, CASE WHEN away_score > home_score THEN 'away' WHEN home_score > away_score THEN 'home' ELSE 'data_anomaly' END AS winner,
  DATE '2026-01-02' AS dt
FROM corrected"""),
    "quarantine": _with("typed scores", """
, planted AS (SELECT game_id, CAST(game_id AS BIGINT) AS n FROM typed t JOIN scores s ON t.k = s.k),
judged AS (
  SELECT game_id, CASE WHEN n % 11 = 0 THEN 'unreadable' WHEN n % 13 = 0 THEN 'no_game_id' WHEN n % 17 = 0 THEN 'score_negative'
    WHEN n % 19 = 0 THEN 'number_untyped' ELSE 'stored' END AS what
  FROM planted)
SELECT what, game_id, CAST(1 AS BIGINT) AS documents FROM judged WHERE what = 'stored'
UNION ALL
SELECT what, NULL, COUNT(*) FROM judged WHERE what <> 'stored' GROUP BY what"""),
    "schema_drift": _with("typed scores", """
, landed AS (SELECT CAST(game_id AS BIGINT) AS n FROM typed t JOIN scores s ON t.k = s.k),
sound AS (SELECT n FROM landed WHERE n % 17 <> 0),
finds AS (
  SELECT '' AS path, 'unreadable' AS problem, NULL AS found, 1 AS times FROM landed WHERE n % 17 = 0
  UNION ALL SELECT 'game.arena', 'unknown', 'OBJECT', 1 FROM sound WHERE n % 7 = 0
  UNION ALL SELECT 'game.gameStatus', 'retyped', 'OBJECT', 1 FROM sound WHERE n % 11 = 0
  UNION ALL SELECT 'game.homeTeam.players[]', 'retyped', unnest(['BIGINT', 'STRING']), unnest([2, 1]) FROM sound WHERE n % 13 = 0
  UNION ALL SELECT 'game.awayTeam.players[]', 'retyped', unnest(['BIGINT', 'STRING']), unnest([2, 1]) FROM sound
    WHERE n % 13 = 0 AND n % 19 <> 0
  UNION ALL SELECT 'game.guestTeam', 'unknown', 'OBJECT', 1 FROM sound WHERE n % 19 = 0)
SELECT path, problem, found, COUNT(*) AS documents, CAST(SUM(times) AS BIGINT) AS occurrences
FROM finds GROUP BY path, problem, found"""),
    "patch_column": _with("keys", """
SELECT game_id, ts AS game_datetime_utc,
  CASE WHEN priority = 5 THEN CASE WHEN status = 1 THEN k + 1 END WHEN k % 3 = 0 THEN k * 10 END AS poll_message_id
FROM keys"""),
    "contract_suite_gold": _contracts(
        "SELECT game_id, game_type, status AS game_status FROM typed",
        "SELECT * FROM boxes",
        "SELECT * FROM facts",
        "SELECT s_suppkey AS player_id FROM supplier",
    ),
    "contract_suite": PLANTED_CONTRACTS,
    "contract_ledger": PLANTED_CONTRACTS,
    "results_digest": DIGEST,
    "results_digest_documents": DIGEST,
    "results_message": _with("games scores", RESULTS + """
SELECT local_date, CAST(COUNT(*) AS BIGINT) AS n_games,
  '🏀 *Resultados — ' || CAST(local_date AS VARCHAR) || '*' || chr(10) || chr(10)
    || string_agg(line, chr(10) || chr(10) ORDER BY game_datetime_utc, game_id) AS body
FROM results WHERE local_date IN (DATE '1997-03-15', DATE '2050-01-01') GROUP BY local_date"""),
    "due_polls": _with("schedule", f"""
, due AS (SELECT *, {local('game_datetime_utc')} AS lt FROM schedule WHERE k % 3 <> 0)
SELECT CAST(lt AS DATE) AS local_date, game_datetime_utc, game_id,
  '📅 *Jogos de Hoje — ' || strftime(lt, '%d/%m') || '*' AS header,
  strftime(lt, '%Hh%M') || COALESCE(' — ' || brazil_broadcaster, '') AS question,
  away_team_city || ' ' || away_team_name || COALESCE(' ' || (away_series_wins + 1) || 'x' || home_series_wins, '') AS away_option,
  home_team_city || ' ' || home_team_name || COALESCE(' ' || (home_series_wins + 1) || 'x' || away_series_wins, '') AS home_option
FROM due"""),
    "poll_close": _with("keys", """
, polls AS (SELECT game_id, k * 10 AS poll_message_id, ts - INTERVAL 10 MINUTE AS close_at FROM keys WHERE k % 3 = 0)
SELECT *, TIMESTAMP '1998-06-01 12:30:00' >= close_at AS is_due,
  CASE WHEN TIMESTAMP '1998-06-01 12:30:00' < close_at
    THEN date_diff('second', TIMESTAMP '1998-06-01 12:30:00', close_at) / 60 END AS minutes_left
FROM polls"""),
    "poll_clear": _with("keys", """
SELECT game_id, ts AS game_datetime_utc,
  CASE WHEN k % 3 = 0 AND TIMESTAMP '1998-06-01 12:30:00' < ts - INTERVAL 10 MINUTE THEN k * 10 END AS poll_message_id
FROM keys"""),
    "outbox": _with("keys", f"""
, days AS (SELECT CAST({local('ts')} AS DATE) AS sent_date, status FROM keys)
(SELECT sent_date, 'polls' AS channel FROM days EXCEPT SELECT sent_date, 'polls' FROM days WHERE status = 1)
UNION ALL
(SELECT sent_date, 'results' FROM days WHERE status = 3 EXCEPT SELECT sent_date, 'results' FROM days WHERE status = 2)"""),
    "leaders": _with("facts", """
, totals AS (SELECT player_id, SUM(pts) AS points, SUM(reb) AS rebounds, SUM(ast) AS assists FROM facts GROUP BY player_id),
long AS (
  SELECT player_id, 'points' AS stat, points AS total FROM totals
  UNION ALL SELECT player_id, 'rebounds', rebounds FROM totals
  UNION ALL SELECT player_id, 'assists', assists FROM totals)
SELECT stat, CAST(place AS INTEGER) AS place, player_id, s_name AS player_name, CAST(total AS BIGINT) AS total
FROM (SELECT *, dense_rank() OVER (PARTITION BY stat ORDER BY total DESC) AS place FROM long)
LEFT JOIN supplier ON player_id = s_suppkey WHERE place <= 10"""),
    "player_form": _with("facts", """
SELECT player_id, game_id, ts AS game_datetime_utc, pts,
  AVG(pts) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS avg_pts,
  pts - LAG(pts) OVER w AS delta_pts
FROM facts WINDOW w AS (PARTITION BY player_id ORDER BY ts, game_id)"""),
    "team_efficiency": _with("games facts", f"""
, t AS (SELECT s.*, {TEAM_COLUMNS} FROM facts s JOIN games g ON s.k = g.k)
SELECT team_id, team_city, team_name, CAST(SUM(pts) AS BIGINT) AS pts,
  SUM(fgm) / NULLIF(SUM(fga), 0) AS fg_rate, SUM(tpm) / NULLIF(SUM(tpa), 0) AS tp_rate,
  SUM(ftm) / NULLIF(SUM(fta), 0) AS ft_rate, SUM(ast) / NULLIF(SUM(tov), 0) AS ast_per_tov
FROM t GROUP BY team_id, team_city, team_name"""),
    "position_distribution": _with("facts players", """
SELECT position, CAST(COUNT(*) AS BIGINT) AS n_lines, CAST(COUNT(mins) AS BIGINT) AS n_timed,
  CAST(SUM(mins) AS DOUBLE) / COUNT(mins) AS avg_minutes, CAST(SUM(pts) AS DOUBLE) / COUNT(pts) AS avg_pts,
  quantile_cont(pts, 0.25) AS pts_q1, quantile_cont(pts, 0.5) AS pts_median, quantile_cont(pts, 0.75) AS pts_q3
FROM facts JOIN players USING (player_id) GROUP BY position"""),
    "plus_minus_context": _with("facts boxes", """
, l AS (
  SELECT f.player_id, f.side, b.game_type, f.plus_minus,
    CASE WHEN b.winner = f.side THEN 'win' WHEN b.winner IN ('home', 'away') THEN 'loss' ELSE 'undecided' END AS outcome
  FROM facts f JOIN boxes b ON f.k = b.k),
u AS (
  SELECT player_id, 'all' AS context, 'all' AS value, plus_minus FROM l
  UNION ALL SELECT player_id, 'side', side, plus_minus FROM l
  UNION ALL SELECT player_id, 'game_type', game_type, plus_minus FROM l
  UNION ALL SELECT player_id, 'outcome', outcome, plus_minus FROM l)
SELECT player_id, context, value, CAST(COUNT(*) AS BIGINT) AS games, CAST(SUM(plus_minus) AS BIGINT) AS plus_minus
FROM u GROUP BY player_id, context, value"""),
    "advanced_metrics": _with("facts", """
, team AS (
  SELECT game_id, side, SUM(fga) AS t_fga, SUM(fta) AS t_fta, SUM(tov) AS t_tov, SUM(mins) AS t_mins
  FROM facts GROUP BY game_id, side),
p AS (
  SELECT player_id, SUM(pts)::DOUBLE AS pts, SUM(fga)::DOUBLE AS fga, SUM(fta)::DOUBLE AS fta, SUM(tov)::DOUBLE AS tov,
    SUM(mins)::DOUBLE AS mins, SUM(t_fga)::DOUBLE AS t_fga, SUM(t_fta)::DOUBLE AS t_fta, SUM(t_tov)::DOUBLE AS t_tov,
    SUM(t_mins)::DOUBLE AS t_mins
  FROM facts JOIN team USING (game_id, side) WHERE mins IS NOT NULL GROUP BY player_id)
SELECT player_id, CAST(mins AS BIGINT) AS minutes,
  CASE WHEN fga + 0.44::DOUBLE * fta > 0 THEN pts / (2 * (fga + 0.44::DOUBLE * fta)) END AS true_shooting,
  CASE WHEN mins > 0 AND t_fga + 0.44::DOUBLE * t_fta + t_tov > 0
    THEN 100 * (fga + 0.44::DOUBLE * fta + tov) * (t_mins / 5) / (mins * (t_fga + 0.44::DOUBLE * t_fta + t_tov)) END AS usage
FROM p"""),
    "incremental_silver": _with("schedule newest", f"""
SELECT s.* EXCLUDE (k, dt, game_status), n.status AS game_status, n.snapshot
FROM schedule s JOIN newest n ON s.k = n.k"""),
}
