"""SQL that gives the same rows on the same tables, written for DuckDB."""

from __future__ import annotations

# Names, labels and thresholds of the result columns. Written out here, not taken from the code under check.
COUNTS = ["goals", "shots", "shots_on_target", "xg", "fouls", "red_cards", "passes"]
DIFFS = ["shots_cum", "shots_on_target_cum", "xg_cum", "shots_last_10", "shots_on_target_last_10", "xg_last_10", "red_cards",
 "fouls_cum", "passes_cum"]
SIDE = {"score_now": "goals_cum",
 "shots_cum": "shots_cum",
 "shots_on_target_cum": "shots_on_target_cum",
 "xg_cum": "xg_cum",
 "shots_last_10": "shots_last_10",
 "shots_on_target_last_10": "shots_on_target_last_10",
 "xg_last_10": "xg_last_10",
 "red_cards": "red_cards_cum",
 "fouls_cum": "fouls_cum",
 "passes_cum": "passes_cum"}
TRAILING = ["shots", "shots_on_target", "xg"]
DERIVED_DIFFS = {"diff_days_rest": "days_since_last_match",
 "diff_lineup_xg": "lineup_xg_sum",
 "diff_lineup_xag": "lineup_xag_sum",
 "diff_lineup_shots": "lineup_shots_sum",
 "diff_lineup_shots_on_target": "lineup_shots_on_target_sum",
 "diff_goalkeeper_save_pct": "goalkeeper_save_pct"}
PRE_DIFFS = {"diff_points_avg": "last5_points_avg",
 "diff_win_rate": "last5_win_rate",
 "diff_goals_for_avg": "last5_goals_for_avg",
 "diff_goals_against_avg": "last5_goals_against_avg",
 "diff_goal_diff_avg": "last5_goal_diff_avg",
 "diff_shots_avg": "last5_shots_avg",
 "diff_shots_on_target_avg": "last5_shots_on_target_avg"}
FORM = {"last5_points_avg": "points",
 "last5_win_rate": "win",
 "last5_draw_rate": "draw",
 "last5_loss_rate": "loss",
 "last5_goals_for_avg": "goals_for",
 "last5_goals_against_avg": "goals_against"}
LINEUP_SUMS = ["xg", "xag", "shots", "shots_on_target", "tackles", "interceptions", "blocks"]
NUMERIC_FEATURES = ["home_matches_played_before", "away_matches_played_before", "home_days_since_last_match",
 "away_days_since_last_match", "home_last5_points_avg", "away_last5_points_avg", "home_last5_win_rate",
 "away_last5_win_rate", "home_last5_draw_rate", "away_last5_draw_rate", "home_last5_loss_rate",
 "away_last5_loss_rate", "home_last5_goals_for_avg", "away_last5_goals_for_avg", "home_last5_goals_against_avg",
 "away_last5_goals_against_avg", "home_last5_goal_diff_avg", "away_last5_goal_diff_avg",
 "home_distinct_players_last5", "away_distinct_players_last5", "home_last5_shots_avg", "away_last5_shots_avg",
 "home_last5_shots_on_target_avg", "away_last5_shots_on_target_avg", "home_lineup_xg_sum", "away_lineup_xg_sum",
 "home_lineup_xag_sum", "away_lineup_xag_sum", "home_lineup_shots_sum", "away_lineup_shots_sum",
 "home_lineup_shots_on_target_sum", "away_lineup_shots_on_target_sum", "home_lineup_tackles_sum",
 "away_lineup_tackles_sum", "home_lineup_interceptions_sum", "away_lineup_interceptions_sum",
 "home_lineup_blocks_sum", "away_lineup_blocks_sum", "home_goalkeeper_save_pct", "away_goalkeeper_save_pct",
 "home_fbref_matched_players", "away_fbref_matched_players", "home_home_last5_points_avg",
 "away_away_last5_points_avg", "home_home_last5_goals_for_avg", "away_away_last5_goals_for_avg",
 "home_home_last5_goals_against_avg", "away_away_last5_goals_against_avg", "diff_points_avg", "diff_win_rate",
 "diff_goals_for_avg", "diff_goals_against_avg", "diff_goal_diff_avg", "diff_shots_avg", "diff_shots_on_target_avg",
 "diff_days_rest", "diff_lineup_xg", "diff_lineup_xag", "diff_lineup_shots", "diff_lineup_shots_on_target",
 "diff_goalkeeper_save_pct", "diff_home_strength", "diff_lineup_defense"]
STATS_SOURCE = {"shots": "shots_total"}
TEAM_FEATURES = ["matches_played_before", "days_since_last_match", "last5_points_avg", "last5_win_rate", "last5_draw_rate",
 "last5_loss_rate", "last5_goals_for_avg", "last5_goals_against_avg", "last5_goal_diff_avg", "distinct_players_last5",
 "last5_shots_avg", "last5_shots_on_target_avg", "lineup_xg_sum", "lineup_xag_sum", "lineup_shots_sum",
 "lineup_shots_on_target_sum", "lineup_tackles_sum", "lineup_interceptions_sum", "lineup_blocks_sum",
 "goalkeeper_save_pct", "fbref_matched_players"]
VENUE = {"last5_points_avg": "points", "last5_goals_for_avg": "goals_for", "last5_goals_against_avg": "goals_against"}
COMPARED = {"Pontos médios últimos 5": ("home_last5_points_avg", "away_last5_points_avg"),
 "Win rate últimos 5": ("home_last5_win_rate", "away_last5_win_rate"),
 "Gols marcados médios": ("home_last5_goals_for_avg", "away_last5_goals_for_avg"),
 "Gols sofridos médios": ("home_last5_goals_against_avg", "away_last5_goals_against_avg"),
 "Saldo médio": ("home_last5_goal_diff_avg", "away_last5_goal_diff_avg"),
 "Pontos em casa/fora": ("home_home_last5_points_avg", "away_away_last5_points_avg"),
 "Finalizações médias": ("home_last5_shots_avg", "away_last5_shots_avg"),
 "Finalizações no alvo": ("home_last5_shots_on_target_avg", "away_last5_shots_on_target_avg"),
 "Jogadores distintos últimos 5": ("home_distinct_players_last5", "away_distinct_players_last5")}
SHARED = ["Pontos médios últimos 5", "Gols marcados médios", "Gols sofridos médios", "Saldo médio", "Pontos em casa/fora",
 "Finalizações médias", "Finalizações no alvo"]
COUNTED = ["goals", "shots", "shots_on_target", "passes_completed", "passes_attempted", "key_passes", "assists",
 "progressive_passes", "progressive_carries", "corners", "dribbles_completed", "tackles", "interceptions", "blocks",
 "clearances", "aerial_duels_won", "fouls_committed", "yellow_cards", "red_cards", "offsides"]
PLAYER_COUNTS = ["goals", "shots", "shots_on_target", "passes_completed", "passes_attempted", "key_passes", "assists",
 "progressive_passes", "progressive_carries", "dribbles_completed", "tackles", "interceptions", "blocks",
 "clearances", "aerial_duels_won", "fouls_committed", "yellow_cards", "red_cards"]
SEASON_COUNTS = ["goals", "assists", "shots", "shots_on_target", "progressive_passes", "progressive_carries", "key_passes", "tackles",
 "interceptions", "blocks", "clearances", "aerial_duels_won", "yellow_cards", "red_cards"]
TEAM_COUNTS = ["shots", "shots_on_target", "passes_completed", "passes_attempted", "key_passes", "progressive_passes",
 "progressive_carries", "corners", "tackles", "interceptions", "blocks", "clearances", "aerial_duels_won",
 "fouls_committed", "yellow_cards", "red_cards", "offsides"]

SLICE = "competition_name IN ('BUILDING','HOUSEHOLD','MACHINERY') AND season_name = '2015/2016'"

CTE: dict[str, str] = {}

CTE["nt"] = "SELECT count(*) AS n FROM supplier"

CTE["m"] = """
SELECT *, CASE WHEN home_score > away_score THEN 'H' WHEN home_score < away_score THEN 'A' ELSE 'D' END AS match_result,
  home_team_id AS stadium_id, 'Stadium ' || home_team_id AS stadium_name
FROM (
  SELECT c_custkey AS match_id, ascii(c_mktsegment) AS competition_id, c_mktsegment AS competition_name,
    s - 1990 AS season_id, s || '/' || (s + 1) AS season_name, match_date,
    (12 + c_custkey % 10) || ':00:00.000' AS kick_off,
    home_team_id, 'Supplier#' || lpad(home_team_id::VARCHAR, 9, '0') AS home_team_name,
    away_team_id, 'Supplier#' || lpad(away_team_id::VARCHAR, 9, '0') AS away_team_name,
    CASE WHEN c_acctbal >= -900 THEN ((c_custkey * 7 + c_nationkey * 3) % 5)::INT END AS home_score,
    ((c_custkey * 5 + c_nationkey) % 4)::INT AS away_score,
    CASE WHEN c_custkey % 17 <> 0 THEN c_nationkey END AS referee_id,
    CASE WHEN c_custkey % 17 <> 0 THEN 'Referee ' || c_nationkey END AS referee_name
  FROM (
    SELECT *, year(match_date) - CASE WHEN month(match_date) < 8 THEN 1 ELSE 0 END AS s,
      (home_team_id + 1 + c_custkey % ((SELECT n FROM nt) - 1)) % (SELECT n FROM nt) AS away_team_id
    FROM (
      SELECT *, DATE '2014-08-01' + (c_custkey * 11 % 1000)::INT AS match_date,
        (c_custkey * 7 + c_custkey // 10) % (SELECT n FROM nt) AS home_team_id
      FROM customer)))
"""

CTE["e"] = """
SELECT *,
  CASE WHEN event_type_name = 'Shot' THEN
    CASE l_returnflag WHEN 'R' THEN 'Goal'
      WHEN 'A' THEN CASE WHEN l_linestatus = 'F' THEN 'Saved To Post' ELSE 'Saved' END ELSE 'Off T' END END AS shot_outcome,
  CASE WHEN event_type_name = 'Shot' AND l_discount > 0 THEN l_discount::DECIMAL(18,6) END AS shot_xg,
  CASE WHEN event_type_name = 'Card' THEN CASE WHEN l_linestatus = 'F' THEN 'Red Card' ELSE 'Yellow Card' END END AS card,
  CASE WHEN minute > 45 THEN 2 ELSE 1 END AS period,
  'Supplier#' || lpad(team_id::VARCHAR, 9, '0') AS team_name,
  event_type_name = 'Pass' AND l_returnflag <> 'N' AS pass_done,
  CASE WHEN l_linenumber <> 6 THEN (l_partkey * 3 % 120)::DOUBLE END AS lx,
  CASE WHEN l_linenumber <> 6 AND l_linenumber <> 5 THEN (l_suppkey * 7 % 80)::DOUBLE END AS ly,
  CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 5 THEN 1 ELSE 2 END AS location_size,
  CASE WHEN event_type_name IN ('Pass', 'Carry') THEN (l_partkey * 3 % 120 + l_linenumber * 4)::DOUBLE END AS ex,
  CASE WHEN event_type_name IN ('Pass', 'Carry') THEN (l_suppkey * 7 % 80 + 3)::DOUBLE END AS ey
FROM (
  SELECT l.*, o_custkey AS match_id, l_partkey AS player_id, l_linenumber AS event_index,
    l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || round(l_extendedprice * 100)::BIGINT AS event_id,
    CASE WHEN l_quantity <> 1 THEN ((l_partkey * 13 + l_suppkey * 7 + l_linenumber * 11) % 96)::INT END AS minute,
    (l_partkey * 17 % 60)::INT AS second,
    CASE WHEN l_linenumber <> 7 OR l_quantity < 48 THEN CASE WHEN l_partkey % 2 = 0 THEN home_team_id ELSE away_team_id END END AS team_id,
    CASE WHEN l_linenumber <= 2 THEN 'Shot' WHEN l_linenumber <= 4 THEN 'Pass' WHEN l_linenumber = 5 THEN 'Foul Committed'
      WHEN l_linenumber = 6 THEN 'Card'
      ELSE ['Pressure', 'Interception', 'Clearance', 'Block', 'Duel', 'Dribble', 'Carry'][(l_suppkey % 7 + 1)::INT] END AS event_type_name
  FROM lineitem l JOIN orders ON o_orderkey = l_orderkey JOIN m ON m.match_id = o_custkey)
"""

CTE["lp"] = """
SELECT match_id, team_id, team_name, player_id, p_name || ' ' || p_type AS player_name, p_size % 30 + 1 AS jersey_number,
  CASE WHEN p_size <= 5 THEN 'GK' ELSE p_type END AS position_name, p_size
FROM (SELECT DISTINCT match_id, team_id, team_name, player_id FROM e WHERE team_id IS NOT NULL) JOIN part ON p_partkey = player_id
"""

# lineup players as the payloads list them
CTE["ll"] = """
SELECT *, CASE WHEN player_id % 9 <> 0 THEN position_name END AS first_position,
  CASE WHEN player_id % 9 <> 0 AND p_size % 6 <> 0 THEN 1 ELSE 0 END AS starter,
  CASE WHEN player_id % 9 <> 0 AND p_size % 4 <> 0 AND p_size % 5 <> 0 THEN 90 - p_size END AS minutes_played
FROM lp WHERE player_id % 11 <> 0
"""

CTE["st"] = """
SELECT p_partkey AS part_key, 'part' AS source_file,
  CASE WHEN p_size % 3 = 0 THEN '2015/2016' ELSE '2025/2026' END AS season_name, p_type AS competition_name,
  CASE WHEN p_size <> 50 THEN p_brand END AS squad_name,
  ' ' || CASE WHEN p_size % 2 = 1 THEN replace(p_name, 'o', 'ó') ELSE p_name END || '  ' || p_type AS player_name,
  CASE WHEN p_size <= 5 THEN 'GK' ELSE 'DF,MF' END AS pos,
  CASE WHEN p_size % 7 <> 0 THEN p_size + 15 END AS age, NULL::INT AS birth_year,
  (p_size * 10)::DOUBLE AS minutes_played, p_size % 20 AS starts, NULL::DOUBLE AS nineties,
  CASE WHEN p_size % 11 <> 0 THEN (p_partkey % 9)::DOUBLE END AS goals, (p_partkey % 7)::DOUBLE AS assists,
  (round(p_retailprice)::BIGINT % 100) / 4.0 AS xg, (round(p_retailprice)::BIGINT % 60) / 4.0 AS xag,
  (p_size * 3)::DOUBLE AS shots_total, (p_size * 2)::DOUBLE AS shots_on_target,
  (p_partkey % 13)::DOUBLE AS tackles, (p_partkey % 11)::DOUBLE AS interceptions,
  CASE WHEN p_size % 5 <> 0 THEN (p_partkey % 5)::DOUBLE END AS blocks,
  NULL::DOUBLE AS clearances, NULL::DOUBLE AS aerials_won, NULL::DOUBLE AS clean_sheets,
  CASE WHEN p_size <= 5 THEN (p_size * 15)::DOUBLE END AS save_pct,
  lower(p_brand) AS brand_low, lower(p_name) || ' ' || lower(p_type) AS folded,
  lower(CASE WHEN p_size % 2 = 1 THEN replace(p_name, 'o', 'ó') ELSE p_name END || ' ' || p_type) AS simple
FROM part WHERE p_size <> 49
"""

_ON = "shot_outcome IN ('Goal', 'Saved', 'Saved To Post')"
CTE["mc"] = f"""
SELECT match_id, team_id, coalesce(minute, 0) AS minute,
  count(*) FILTER (shot_outcome = 'Goal') AS goals, count(*) FILTER (event_type_name = 'Shot') AS shots,
  count(*) FILTER ({_ON}) AS shots_on_target, coalesce(sum(shot_xg), 0)::DECIMAL(28,6) AS xg,
  count(*) FILTER (event_type_name = 'Foul Committed') AS fouls, count(*) FILTER (card = 'Red Card') AS red_cards,
  count(*) FILTER (event_type_name = 'Pass') AS passes
FROM e WHERE coalesce(minute, 0) BETWEEN 1 AND 90 GROUP BY ALL
"""

CTE["grid"] = f"""
SELECT g.match_id, g.team_id, g.minute, {', '.join(f'coalesce({c}, 0) AS {c}' for c in COUNTS)}
FROM (SELECT match_id, unnest([home_team_id, away_team_id]) AS team_id, r.minute FROM m, (SELECT unnest(range(1, 91)) AS minute) r) g
LEFT JOIN mc ON mc.match_id = g.match_id AND mc.team_id = g.team_id AND mc.minute = g.minute
"""

CTE["roll"] = f"""
SELECT match_id, team_id, minute,
  {', '.join(f'sum({c}) OVER w AS {c}_cum' for c in COUNTS)},
  {', '.join(f'sum({c}) OVER t AS {c}_last_10' for c in TRAILING)}
FROM grid
WINDOW w AS (PARTITION BY match_id, team_id ORDER BY minute ROWS UNBOUNDED PRECEDING),
  t AS (PARTITION BY match_id, team_id ORDER BY minute ROWS 9 PRECEDING)
"""


def _real(name: str, expr: str) -> str:
    return f"({expr})::{'DOUBLE' if 'xg' in name else 'BIGINT'} AS {name}"


_MATCH = "match_id, match_date, competition_name, season_name, home_team_id, home_team_name, away_team_id, away_team_name"
CTE["pair"] = f"""
SELECT r.match_id, r.minute,
  {', '.join(f'max(CASE WHEN r.team_id = m.{s}_team_id THEN r.{src} END) AS {s}_{src}' for src in SIDE.values() for s in ('home', 'away'))}
FROM roll r JOIN m ON m.match_id = r.match_id GROUP BY r.match_id, r.minute
"""

CTE["f"] = f"""
SELECT m.match_id, strftime(match_date, '%Y-%m-%d') AS match_date, competition_name, season_name, home_team_id, home_team_name,
  away_team_id, away_team_name, p.minute,
  {', '.join(_real(f'{s}_{n}', f'p.{s}_{src}') for n, src in SIDE.items() for s in ('home', 'away'))},
  (p.home_goals_cum - p.away_goals_cum)::BIGINT AS goal_diff_now,
  {', '.join(_real(f'diff_{n}', f'p.home_{SIDE[n]} - p.away_{SIDE[n]}') for n in DIFFS)},
  90 - p.minute AS remaining_minutes, match_result AS target_result_final
FROM m JOIN pair p ON p.match_id = m.match_id
"""

CTE["tp"] = """
SELECT *, CASE form WHEN 'W' THEN 3 WHEN 'D' THEN 1 WHEN 'L' THEN 0 END AS points,
  CASE WHEN form IS NOT NULL THEN (form = 'W')::INT END AS win, CASE WHEN form IS NOT NULL THEN (form = 'D')::INT END AS draw,
  CASE WHEN form IS NOT NULL THEN (form = 'L')::INT END AS loss
FROM (SELECT *, CASE WHEN goals_for > goals_against THEN 'W' WHEN goals_for = goals_against THEN 'D' WHEN goals_for < goals_against THEN 'L' END AS form
  FROM (
  SELECT match_id, match_date, competition_name, season_name, home_team_id AS team_id, home_team_name AS team_name,
    away_team_id AS opponent_team_id, 1 AS is_home, home_score AS goals_for, away_score AS goals_against FROM m
  UNION ALL
  SELECT match_id, match_date, competition_name, season_name, away_team_id, away_team_name, home_team_id, 0, away_score, home_score FROM m))
"""


def _mean(field: str, window: str) -> str:
    return f"sum({field}) OVER {window} / nullif(count({field}) OVER {window}, 0)::DOUBLE"


CTE["hist"] = f"""
SELECT *, last5_goals_for_avg - last5_goals_against_avg AS last5_goal_diff_avg FROM (
SELECT match_id, match_date, team_id, is_home,
  row_number() OVER (PARTITION BY team_id ORDER BY match_date, match_id) - 1 AS matches_played_before,
  datediff('day', lag(match_date) OVER (PARTITION BY team_id ORDER BY match_date, match_id), match_date) AS days_since_last_match,
  {', '.join(f'{_mean(x, "w")} AS {n}' for n, x in FORM.items())}
FROM tp WINDOW w AS (PARTITION BY team_id ORDER BY match_date, match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
"""

CTE["venue"] = f"""
SELECT match_id, team_id, is_home, {', '.join(f'{_mean(x, "w")} AS venue_{n}' for n, x in VENUE.items())}
FROM tp WINDOW w AS (PARTITION BY team_id, is_home ORDER BY match_date, match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
"""

CTE["pos"] = "SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY match_date, match_id) AS k FROM tp"

CTE["links"] = """
SELECT a.match_id, a.team_id, b.match_id AS earlier_id FROM pos a JOIN pos b ON a.team_id = b.team_id AND b.k BETWEEN a.k - 5 AND a.k - 1
"""

CTE["dp"] = """
SELECT l.match_id, l.team_id, count(DISTINCT player_id) AS distinct_players_last5
FROM links l JOIN lp ON lp.match_id = l.earlier_id AND lp.team_id = l.team_id GROUP BY ALL
"""

CTE["rs"] = f"""
SELECT l.match_id, l.team_id, sum(coalesce(shots, 0)) / count(*)::DOUBLE AS last5_shots_avg,
  sum(coalesce(sot, 0)) / count(*)::DOUBLE AS last5_shots_on_target_avg
FROM links l JOIN (SELECT DISTINCT match_id FROM e) known ON known.match_id = l.earlier_id
LEFT JOIN (SELECT match_id, team_id, count(*) FILTER (event_type_name = 'Shot') AS shots, count(*) FILTER ({_ON}) AS sot
  FROM e GROUP BY ALL) s ON s.match_id = l.earlier_id AND s.team_id = l.team_id
GROUP BY ALL
"""

CTE["ls"] = f"""
SELECT match_id, team_id, {', '.join(f'sum({s})::DOUBLE AS lineup_{s}_sum' for s in LINEUP_SUMS)},
  max(save_pct) AS goalkeeper_save_pct, count(DISTINCT player_id) AS fbref_matched_players
FROM (SELECT DISTINCT match_id, team_id, player_id, lower(player_name) AS folded FROM lp) JOIN (
  SELECT folded, {', '.join(f'sum({STATS_SOURCE.get(s, s)}::DECIMAL(18,6)) AS {s}' for s in LINEUP_SUMS)},
    max(CASE WHEN pos LIKE '%GK%' THEN save_pct END) AS save_pct FROM st GROUP BY folded) USING (folded)
GROUP BY ALL
"""

CTE["tf"] = """
SELECT hist.* EXCLUDE (match_date), venue.* EXCLUDE (match_id, team_id, is_home), rs.* EXCLUDE (match_id, team_id),
  ls.* EXCLUDE (match_id, team_id, fbref_matched_players), coalesce(distinct_players_last5, 0) AS distinct_players_last5,
  coalesce(fbref_matched_players, 0) AS fbref_matched_players
FROM hist JOIN venue USING (match_id, team_id) LEFT JOIN dp USING (match_id, team_id)
LEFT JOIN rs USING (match_id, team_id) LEFT JOIN ls USING (match_id, team_id)
"""

CTE["tg"] = """
SELECT match_id, CASE WHEN home_score IS NOT NULL THEN match_result END AS target_result,
  (home_score > away_score)::INT AS target_home_win, (home_score = away_score)::INT AS target_draw,
  (home_score < away_score)::INT AS target_away_win, (home_score + away_score > 2.5)::INT AS target_over_25,
  CASE WHEN home_score IS NOT NULL THEN (home_score > 0 AND away_score > 0)::INT END AS target_btts
FROM m
"""


def _defense(s: str) -> str:
    return " + ".join(f"coalesce({s}_lineup_{x}_sum, 0)" for x in ("tackles", "interceptions", "blocks"))


CTE["pf"] = f"""
SELECT w.* EXCLUDE (match_date), strftime(match_date, '%Y-%m-%d') AS match_date,
  {', '.join(f'home_{t} - away_{t} AS {n}' for n, t in {**PRE_DIFFS, **DERIVED_DIFFS}.items())},
  home_home_last5_points_avg - away_away_last5_points_avg AS diff_home_strength,
  ({_defense('home')}) - ({_defense('away')}) AS diff_lineup_defense,
  tg.* EXCLUDE (match_id)
FROM (SELECT {', '.join('m.' + c.strip() for c in _MATCH.split(','))},
    {', '.join(f'{s[0]}.{t} AS {s}_{t}' for t in TEAM_FEATURES for s in ('home', 'away'))},
    {', '.join(f'{s[0]}.venue_{v} AS {s}_{s}_{v}' for v in VENUE for s in ('home', 'away'))}
  FROM m JOIN tf h ON h.match_id = m.match_id AND h.is_home = 1 JOIN tf a ON a.match_id = m.match_id AND a.is_home = 0) w
JOIN tg ON tg.match_id = w.match_id
"""

_RULES = {
    "goals": "shot_outcome = 'Goal'", "shots": "event_type_name = 'Shot'", "shots_on_target": _ON,
    "passes_completed": "pass_done", "passes_attempted": "event_type_name = 'Pass'",
    "key_passes": "event_type_name = 'Pass' AND l_returnflag IN ('R', 'A')",
    "assists": "event_type_name = 'Pass' AND l_returnflag = 'R'",
    "progressive_passes": "pass_done AND ex - lx >= 10", "progressive_carries": "event_type_name = 'Carry' AND ex - lx >= 10",
    "corners": "event_type_name = 'Pass' AND l_linestatus = 'F'",
    "dribbles_completed": "event_type_name = 'Dribble' AND l_linestatus = 'F'",
    "tackles": "event_type_name = 'Duel' AND l_linestatus = 'F'", "interceptions": "event_type_name = 'Interception'",
    "blocks": "event_type_name = 'Block'", "clearances": "event_type_name = 'Clearance'",
    "aerial_duels_won": "event_type_name = 'Clearance' AND l_returnflag = 'A'",
    "fouls_committed": "event_type_name = 'Foul Committed'", "yellow_cards": "card = 'Yellow Card'",
    "red_cards": "card = 'Red Card'", "offsides": "event_type_name = 'Offside'",
}
_COUNTS = ", ".join(f"count(*) FILTER ({_RULES[c]}) AS {c}" for c in COUNTED)
CTE["es"] = f"""
SELECT match_id, team_id, player_id, {_COUNTS}, coalesce(sum(shot_xg), 0) AS xg FROM e WHERE team_id IS NOT NULL GROUP BY ALL
"""
CTE["ps"] = f"""
SELECT match_id, team_id, player_id, coalesce(minutes_played, 0) AS minutes_played, starter AS started,
  {', '.join(f'coalesce({c}, 0) AS {c}' for c in PLAYER_COUNTS)}, coalesce(xg, 0)::DECIMAL(28,6) AS xg
FROM ll LEFT JOIN es USING (match_id, team_id, player_id)
"""

CTE["split"] = """
SELECT *, CASE WHEN k <= floor(n * 0.70) THEN 'train' WHEN k <= floor(n * 0.85) THEN 'valid' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY match_date, match_id) AS k, count(*) OVER () AS n FROM m)
"""


def _w(i: int, j: int) -> str:
    return f"(1 + match_id * {i + 2} * {j + 3} % 7)::DOUBLE"


def _variant(i: int, name: str) -> str:
    total = " + ".join(_w(i, j) for j in range(3))
    ps = ", ".join(f"{_w(i, j)} / ({total}) AS p_{c}" for j, c in enumerate("ADH"))
    return f"SELECT match_id, split, match_result AS label, home_team_name, away_team_name, '{name}' AS model, {ps} FROM split"


CTE["sc"] = f"""
SELECT *, CASE WHEN p_A >= p_D AND p_A >= p_H THEN 'A' WHEN p_D >= p_H THEN 'D' ELSE 'H' END AS prediction,
  CASE label WHEN 'A' THEN p_A WHEN 'D' THEN p_D ELSE p_H END AS p_true
FROM ({' UNION ALL '.join(_variant(i, v) for i, v in enumerate(('no_calibration', 'sigmoid', 'isotonic')))})
"""

CTE["res"] = """
SELECT model, split, sum(n) AS rows, sum(hit) / sum(n) AS accuracy, avg(hit / n) AS balanced_accuracy, sum(loss) / sum(n) AS log_loss
FROM (SELECT model, split, label, count(*)::DOUBLE AS n, count(*) FILTER (label = prediction)::DOUBLE AS hit, sum(-ln(p_true)) AS loss
  FROM sc GROUP BY ALL) GROUP BY ALL
"""

CTE["offers"] = """
SELECT match_id, outcome, model_probability, 1 + ((match_id * 7 + ascii(outcome)) % 40) / 8.0 AS market_odd,
  model_probability * (1 + ((match_id * 7 + ascii(outcome)) % 40) / 8.0) AS recommendation_score
FROM (SELECT match_id, unnest(['A', 'D', 'H']) AS outcome, unnest([p_A, p_D, p_H]) AS model_probability FROM sc WHERE model = 'no_calibration')
"""

CTE["picks"] = """
SELECT * FROM (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY recommendation_score DESC, match_id, outcome) AS position, match_id,
    outcome, model_probability, market_odd, recommendation_score, max_selections
  FROM (
    SELECT * FROM (SELECT DISTINCT user_id, user_id % 4 + 1 AS max_selections, [0.55, 0.35, 0.0][(user_id % 3 + 1)::INT] AS least,
        (user_id * 3 + i) % (SELECT count(*) FROM customer) AS match_id
      FROM (SELECT DISTINCT user_id FROM events), (SELECT unnest(range(1, 401)) AS i)
      WHERE i <= CASE WHEN user_id % 50 = 0 THEN 400 ELSE user_id % 40 + 1 END) JOIN offers USING (match_id)
    WHERE model_probability >= least
    QUALIFY row_number() OVER (PARTITION BY user_id, match_id ORDER BY recommendation_score DESC, outcome) = 1)) WHERE position <= max_selections
"""

CTE["upd"] = """
SELECT user_id, event_type, CASE WHEN value <= 100 THEN value END AS value, CASE WHEN event_id % 2 = 0 THEN props END AS props,
  'event' AS origin, event_id AS k FROM events
UNION ALL SELECT c_custkey, 'signup', c_acctbal, '{}', 'account', -1 FROM customer
"""

CTE["par"] = r"""
SELECT *, trim(regexp_replace(lower(player_name), '\s+', ' ', 'g')) AS normalized_player_name FROM (
SELECT p_partkey AS raw_fbref_player_id,
  CASE WHEN p_size <> 49 THEN ' ' || CASE WHEN p_size % 2 = 1 THEN replace(p_name, 'o', 'ó') ELSE p_name END || '  ' || p_type ELSE '  ' END AS player_name,
  NULL::VARCHAR AS nationality, CASE WHEN p_size % 7 <> 0 THEN p_size + 15 END AS age, NULL::VARCHAR AS preferred_position,
  CASE WHEN p_size <> 50 THEN p_brand END AS team_name, p_type AS competition_name, NULL::INT AS matches_played, p_size % 20 AS starts,
  p_size * 10 AS minutes_played, CASE WHEN p_size % 11 <> 0 THEN p_partkey % 9 END AS goals, p_partkey % 7 AS assists, p_size * 3 AS shots,
  p_size * 2 AS shots_on_target, (round(p_retailprice)::BIGINT % 100) / 4.0 AS xg, (round(p_retailprice)::BIGINT % 60) / 4.0 AS xa,
  NULL::INT AS progressive_passes, NULL::INT AS progressive_carries, NULL::INT AS key_passes, p_partkey % 13 AS tackles,
  p_partkey % 11 AS interceptions, NULL::INT AS blocks, NULL::INT AS clearances, NULL::INT AS aerial_duels_won,
  NULL::INT AS yellow_cards, NULL::INT AS red_cards FROM part)
"""

# names of players: lineups first, then statistics
CTE["pl"] = """
SELECT normalized_player_name, coalesce(s_name, l_name) AS player_name, s_age AS age, l_nat AS nationality, l_pos AS preferred_position
FROM (SELECT normalized_player_name, arg_max(player_name, raw_fbref_player_id) AS s_name,
    arg_max(age, raw_fbref_player_id) FILTER (age IS NOT NULL) AS s_age FROM par GROUP BY 1)
FULL JOIN (SELECT lower(player_name) AS normalized_player_name, player_name AS l_name, 'Country ' || jersey_number AS l_nat, first_position AS l_pos
  FROM ll QUALIFY row_number() OVER (PARTITION BY player_name ORDER BY player_id) = 1) USING (normalized_player_name)
"""

CTE["lut"] = "SELECT home_team_id AS id, home_team_name AS name FROM m UNION SELECT away_team_id, away_team_name FROM m"

_DEPENDS: dict[str, list[str]] = {
    "m": ["nt"], "e": ["m"], "lp": ["e"], "ll": ["lp"], "mc": ["e"], "grid": ["mc"], "roll": ["grid"], "pair": ["roll"], "f": ["pair"],
    "tp": ["m"], "hist": ["tp"], "venue": ["tp"], "pos": ["tp"], "links": ["pos"], "dp": ["links", "lp"], "rs": ["links", "e"],
    "ls": ["lp", "st"], "tf": ["hist", "venue", "dp", "rs", "ls"], "tg": ["m"], "pf": ["tf", "tg"], "es": ["e"], "ps": ["ll", "es"],
    "split": ["m"], "sc": ["split"], "res": ["sc"], "offers": ["sc"], "picks": ["offers"], "raws": ["m", "docs"], "pk": ["lp"], "qk": ["st"], "nr": ["pk", "qk"], "tr": ["pk", "qk"], "won": ["nr", "tr"],
    "cr": ["tk", "ck"], "tm": ["cr"], "pl": ["ll", "par"], "lut": ["m"],
}
_MATERIALIZED = {"m", "e", "lp", "ll", "mc", "grid", "roll", "pair", "pk", "qk", "nr", "tr", "tk", "ck", "cr", "tm", "hist", "tf", "st", "tp", "pos", "links"}

ORACLE: dict[str, str] = {}


def add(name: str, needs: str, body: str) -> None:
    """Registers ``body`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(c: str) -> None:
        for d in _DEPENDS.get(c, []):
            visit(d)
        if c not in order:
            order.append(c)

    for c in needs.split():
        visit(c)
    ctes = ",\n".join(f"{c} AS {'MATERIALIZED ' if c in _MATERIALIZED else ''}({CTE[c].strip()})" for c in order)
    ORACLE[name] = f"WITH {ctes}\n{body}" if order else body


# ------------------------------------------------------------------ entity resolution


def _words(text: str) -> str:
    """Lower case, words in order, one blank between."""
    return f"array_to_string(list_sort(string_split(trim(regexp_replace(lower(coalesce({text}, '')), '\\s+', ' ', 'g')), ' ')), ' ')"


def _ratios(left: str, right: str) -> str:
    """(a, b, r) for all pairs of two lists of short texts: the longest common subsequence with the positions of ``a`` as bits."""
    return f"""
SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 100.0::DOUBLE ELSE (1.0::DOUBLE - (length(a) + length(b) - 2 * common)::DOUBLE / (length(a) + length(b))) * 100.0::DOUBLE END AS r
FROM (SELECT a, b, length(a) - bit_count(list_reduce(list_prepend(every, list_transform(string_split(b, ''), lambda c: coalesce(bits[c], 0))),
        lambda s, x: ((s + (s & x)) | (s - (s & x))) & every)) AS common
  FROM (SELECT a, (1::BIGINT << length(a)::BIGINT) - 1 AS every, map(letters, list_transform(letters, lambda c: list_sum(list_transform(range(length(a)),
          lambda i: CASE WHEN substring(a, i + 1, 1) = c THEN 1::BIGINT << i ELSE 0::BIGINT END))::BIGINT)) AS bits
    FROM (SELECT a, list_distinct(string_split(a, '')) AS letters FROM (SELECT DISTINCT {left}))),
  (SELECT DISTINCT {right}))"""


CTE["pk"] = f"SELECT DISTINCT player_id, player_name, team_name, {_words('player_name')} AS ln, {_words('team_name')} AS lt FROM lp"
CTE["qk"] = f"SELECT part_key, player_name, squad_name, {_words('player_name')} AS rn, {_words('squad_name')} AS rt FROM st"
CTE["nr"] = _ratios("ln AS a FROM pk", "rn AS b FROM qk")
CTE["tr"] = _ratios("lt AS a FROM pk", "rt AS b FROM qk")
CTE["won"] = """
SELECT ln, lt, first(part_key ORDER BY score DESC, part_key) AS id, max(score) AS score FROM (
  SELECT ln, lt, part_key, printf('%.2f', 0.8::DOUBLE * nr.r + 0.2::DOUBLE * tr.r)::DOUBLE AS score
  FROM (SELECT DISTINCT ln, lt FROM pk), (SELECT rn, rt, min(part_key) AS part_key FROM qk GROUP BY rn, rt), nr, tr
  WHERE nr.a = ln AND nr.b = rn AND tr.a = lt AND tr.b = rt) GROUP BY ln, lt
"""
_STATUS = "CASE WHEN score >= 95 THEN 'auto_approved' WHEN score >= 85 THEN 'needs_review' ELSE 'low_confidence' END"
CTE["tk"] = f"SELECT s_suppkey AS team_id, s_name AS team_name, {_words('s_name')} AS ln FROM supplier"
CTE["ck"] = f"SELECT team_id, team_name, {_words('team_name')} AS rn FROM (SELECT c_custkey AS team_id, substring(c_name, 10, 9) || ' Supplier Club ' || c_mktsegment AS team_name FROM customer)"
CTE["cr"] = _ratios("ln AS a FROM tk", "rn AS b FROM ck")
CTE["tm"] = f"""
SELECT team_id, team_id::VARCHAR AS statsbomb_team_id, team_name AS statsbomb_team_name, id::VARCHAR AS fbref_team_id, name AS fbref_team_name,
  '2015/2016' AS season_name, score AS confidence_score, {_STATUS} AS mapping_status
FROM tk JOIN (SELECT a, first(team_id ORDER BY score DESC, team_id) AS id, first(team_name ORDER BY score DESC, team_id) AS name, max(score) AS score
  FROM (SELECT a, team_id, team_name, printf('%.2f', r)::DOUBLE AS score FROM cr JOIN ck ON b = rn) GROUP BY a) ON a = ln WHERE score > 0
"""


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _file(kind: str) -> str:
    return f"CASE WHEN match_id % 3 = 0 THEN 'C:\\data\\{kind}\\' ELSE '/data/{kind}/' END || match_id || '.json'"


_KEYS = f"""match_id, competition_id, competition_name, season_id, season_name, {_day('match_date')} AS match_date, kick_off,
  home_team_id, home_team_name, away_team_id, away_team_name, home_score, away_score"""

# ---- silver
add("match_id_from_file", "e", f"""SELECT {_file('events')} AS source_file, count(*) AS events, match_id || '.json' AS base_name, match_id,
  match_id::VARCHAR AS match_id_text, 'raw_events' AS target_table FROM e GROUP BY match_id""")
add("target_slice", "m", f"SELECT match_id::VARCHAR AS match_id_text, match_id || '.json' AS match_file_name, {_KEYS} FROM m WHERE {SLICE}")
CTE["docs"] = """
SELECT c_custkey AS k, c_custkey % 6 AS kind, CASE c_custkey % 6 WHEN 0 THEN 'C:\\data\\lineups\\' || c_custkey || '.json'
  WHEN 1 THEN '/data/events/' || c_custkey || '.json' WHEN 2 THEN '/data/other/' || c_custkey || '.json'
  WHEN 3 THEN '/data/players/' || c_custkey || '.json' WHEN 4 THEN '/data/lineups/' || c_custkey || '.json'
  ELSE '/data/events/x' || c_custkey || '.json.json' END AS source_file FROM customer
"""
CTE["raws"] = """
SELECT 'raw_matches' AS target_table, 'data/matches/' || competition_id || '/' || season_id || '.json' AS source_file, season_id::VARCHAR AS source_match_id,
  (row_number() OVER (PARTITION BY competition_id, season_id ORDER BY match_id) - 1)::INT AS row_in_file, match_id::VARCHAR AS match_id FROM m
UNION ALL SELECT 'raw_lineups', source_file, k::VARCHAR, 0, k::VARCHAR FROM docs WHERE kind = 0
UNION ALL SELECT NULL, source_file, k::VARCHAR, 0, k::VARCHAR FROM docs WHERE kind = 2
UNION ALL SELECT 'raw_events', source_file, 'x' || k, i, CASE WHEN i = 0 THEN k::VARCHAR END FROM docs, (SELECT unnest([0, 1]) AS i) WHERE kind = 5
"""
add("raw_documents", "docs raws", "SELECT *, 'star' AS source_dataset, '2024-01-01' AS loaded FROM raws")
add("raw_routing", "docs raws", """SELECT coalesce(target_table, 'unknown') AS target, count(*) AS rows, count(DISTINCT source_file || ':' || row_in_file) AS ids FROM raws GROUP BY 1
UNION ALL SELECT 'no JSON array or object', count(*), NULL FROM docs WHERE kind IN (1, 3)""")
add("csv_layouts", "", """
SELECT replace(p_brand, '#', '') || '_' || p_partkey % 3 || '.csv' AS source_file,
  CASE WHEN p_partkey % 3 = 1 AND p_size % 2 = 0 THEN '2015/2016' ELSE '2025/2026' END AS season_name, NULL::VARCHAR AS competition_name,
  CASE WHEN p_size % 5 <> 0 THEN p_brand END AS squad_name, p_name || ', ' || p_type AS player_name, NULL::VARCHAR AS pos,
  CASE WHEN p_partkey % 3 = 0 AND p_size % 7 <> 0 THEN p_size::INT END AS age, NULL::INT AS birth_year,
  CASE WHEN p_partkey % 3 = 1 THEN (p_size * 10)::DOUBLE END AS minutes_played, NULL::INT AS starts, NULL::DOUBLE AS nineties, NULL::DOUBLE AS goals,
  NULL::DOUBLE AS assists, CASE WHEN p_partkey % 3 = 0 THEN p_size + 0.25::DOUBLE END AS xg, NULL::DOUBLE AS xag, NULL::DOUBLE AS shots_total,
  NULL::DOUBLE AS shots_on_target, NULL::DOUBLE AS tackles, NULL::DOUBLE AS interceptions, NULL::DOUBLE AS blocks, NULL::DOUBLE AS clearances,
  NULL::DOUBLE AS aerials_won, NULL::DOUBLE AS clean_sheets, NULL::DOUBLE AS save_pct,
  CASE WHEN p_size % 5 <> 0 THEN replace(lower(p_brand), '#', ' ') END AS normalized_squad_name,
  trim(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', ' ', 'g')) AS normalized_player_name
FROM part WHERE p_partkey % 3 <> 2 AND p_partkey % 11 <> 0 AND p_partkey % 13 <> 0""")
add("silver_matches", "m", f"""SELECT {_KEYS}, match_result, stadium_id, stadium_name, referee_id, referee_name, '1.1.0' AS data_version,
  '' AS shot_fidelity_version, NULL::VARCHAR AS xy_fidelity_version, 'star' AS source_dataset,
  'data/matches/' || competition_id || '/' || season_id || '.json' AS source_file FROM m""")
add("silver_events", "e", f"""SELECT event_id, match_id, event_index, period,
  '00:' || lpad(coalesce(minute, 0)::VARCHAR, 2, '0') || ':' || lpad(second::VARCHAR, 2, '0') || '.000' AS event_timestamp,
  minute, second::DOUBLE AS second, event_index AS possession, team_id AS possession_team_id, team_name AS possession_team_name,
  1 AS play_pattern_id, 'Regular Play' AS play_pattern_name, team_id, team_name, player_id, p_name || ' ' || p_type AS player_name,
  CASE WHEN player_id % 4 <> 0 THEN (player_id % 25 + 1)::INT END AS position_id, CASE WHEN player_id % 4 <> 0 THEN 'Position ' || (player_id % 25 + 1) END AS position_name,
  length(event_type_name) + 10 AS event_type_id, event_type_name, second / 8.0 AS duration,
  CASE WHEN l_tax > 0.05 THEN 1 END AS under_pressure, CASE WHEN player_id % 13 = 0 THEN 1 END AS off_camera, CASE WHEN player_id % 17 = 0 THEN 1 END AS out_of_play,
  CASE location_size WHEN 1 THEN lx::VARCHAR WHEN 2 THEN lx || ',' || ly END AS location,
  CASE WHEN event_type_name = 'Pass' THEN ey::VARCHAR END AS pass_payload, shot_outcome AS shot_payload, CASE WHEN event_type_name = 'Carry' THEN ex::VARCHAR END AS carry_payload,
  CASE WHEN event_type_name = 'Interception' THEN 'Won' END AS interception_payload, CASE WHEN event_type_name = 'Block' THEN 'Save' END AS goalkeeper_payload,
  CASE WHEN event_type_name = 'Pressure' THEN event_index::VARCHAR END AS tactics_payload, card AS bad_behaviour_payload,
  (event_type_name = 'Dribble')::INT AS dribble_payload, (event_type_name = 'Duel')::INT AS duel_payload, (event_type_name = 'Clearance')::INT AS clearance_payload,
  event_id AS raw_payload, 'star' AS source_dataset, {_file('events')} AS source_file FROM e LEFT JOIN part ON p_partkey = player_id""")
_OF = lambda kind, value: f"CASE WHEN event_type_name = '{kind}' THEN {value} END"
add("event_payload_fields", "e", f"""SELECT event_id, {_OF('Pass', 'ex::VARCHAR')} AS pass_end_location_0, {_OF('Pass', 'ey::VARCHAR')} AS pass_end_location_1,
  CASE WHEN event_type_name = 'Pass' AND l_returnflag = 'R' THEN 'true' END AS pass_goal_assist, CASE WHEN event_type_name = 'Pass' AND l_returnflag = 'A' THEN 'true' END AS pass_shot_assist,
  CASE WHEN event_type_name = 'Pass' AND l_returnflag = 'N' THEN 'Incomplete' END AS pass_outcome_name, CASE WHEN event_type_name = 'Pass' AND l_linestatus = 'F' THEN 'Corner' END AS pass_type_name,
  shot_xg::DOUBLE AS shot_statsbomb_xg, shot_outcome AS shot_outcome_name, {_OF('Carry', 'ex::VARCHAR')} AS carry_end_location_0, {_OF('Carry', 'ey::VARCHAR')} AS carry_end_location_1,
  card AS bad_behaviour_card_name, {_OF('Duel', "CASE WHEN l_linestatus = 'F' THEN 'Tackle' ELSE 'Aerial Lost' END")} AS duel_type_name,
  {_OF('Dribble', "CASE WHEN l_linestatus = 'F' THEN 'Complete' ELSE 'Incomplete' END")} AS dribble_outcome_name,
  {_OF('Interception', "'4'")} AS interception_outcome_id, {_OF('Interception', "'Won'")} AS interception_outcome_name,
  {_OF('Block', '(player_id % 9)::VARCHAR')} AS goalkeeper_type_id, {_OF('Block', "'Save'")} AS goalkeeper_type_name,
  {_OF('Pressure', "'442'")} AS tactics_formation, {_OF('Pressure', 'event_index::VARCHAR')} AS tactics_lineup_0_jersey_number,
  CASE WHEN event_type_name = 'Clearance' AND l_returnflag = 'A' THEN 'true' END AS clearance_aerial_won FROM e""")
_LISTED = lambda value: f"CASE WHEN player_id % 9 <> 0 THEN {value} END"
_FROM = "CASE WHEN p_size % 4 = 0 THEN '00:00' ELSE p_size::VARCHAR END"
add("lineup_payload_fields", "ll", f"""SELECT match_id, team_id, player_id, CASE WHEN player_id % 9 <> 0 THEN 1 ELSE 0 END AS positions, first_position AS position,
  {_LISTED(_FROM)} AS from_time, {_LISTED("CASE WHEN p_size % 5 <> 0 THEN '90' END")} AS to_time, {_LISTED("CASE WHEN p_size % 6 = 0 THEN '' ELSE 'Starting XI' END")} AS start_reason,
  CASE WHEN player_id % 6 = 0 THEN '45:00' END AS card_time, CASE WHEN player_id % 6 = 0 THEN 'Yellow Card' END AS card_type,
  jersey_number::VARCHAR AS jersey, 'Country ' || jersey_number AS country, {_LISTED(_FROM)} AS raw_from FROM ll""")
add("json_props", "", """SELECT event_id, event_type, TRY_CAST(props->>'k' AS INT) AS k, TRY_CAST(props->>'k' AS DOUBLE) AS k_real,
  props->>'absent' AS absent FROM events""")
add("event_location", "e", """SELECT event_id, CASE WHEN location_size = 2 THEN lx END AS start_x, CASE WHEN location_size = 2 THEN ly END AS start_y,
  CASE WHEN event_type_name = 'Pass' THEN ex END AS end_x, CASE WHEN event_type_name = 'Pass' THEN ey END AS end_y FROM e""")
add("lineup_headers", "lp", f"SELECT match_id, team_id, team_name, {_file('lineups')} AS source_file, count(*) AS payloads FROM lp GROUP BY ALL")
add("lineup_players_explode", "ll", """SELECT match_id, team_id, team_name, player_id, player_name,
  CASE WHEN player_id % 2 <> 0 THEN player_name END AS player_nickname, jersey_number, jersey_number AS country_id,
  'Country ' || jersey_number AS country_name, first_position AS positions, player_name AS raw_player_payload,
  CASE WHEN player_id % 6 = 0 THEN 'Yellow Card' END AS cards_payload FROM ll""")
add("lineup_position_minutes", "ll", "SELECT match_id, team_id, player_id, first_position AS position_name, starter, minutes_played FROM ll")
_ST = """season_name, competition_name, squad_name, player_name, pos, age, birth_year, minutes_played, starts, nineties, goals, assists,
  xg, xag, shots_total, shots_on_target, tackles, interceptions, blocks, clearances, aerials_won, clean_sheets, save_pct"""
add("player_stats_normalized", "st", f"""SELECT source_file, {_ST}, CASE WHEN squad_name IS NOT NULL THEN replace(brand_low, '#', ' ') END AS normalized_squad_name,
  folded AS normalized_player_name, squad_name AS raw_payload FROM st""")
add("first_usable_value", "par", "SELECT * EXCLUDE normalized_player_name FROM par")
add("name_keys", "", """SELECT p_partkey AS part_key, CASE WHEN p_size = 49 THEN '' ELSE lower(CASE WHEN p_size % 2 = 1 THEN replace(p_name, 'o', 'ó') ELSE p_name END || ' ' || p_type) END AS simple,
  CASE WHEN p_size <> 49 THEN lower(p_name || ' ' || p_type) END AS folded, CASE WHEN p_size <> 50 THEN replace(lower(p_brand), '#', ' ') END AS squad FROM part""")

# ---- in-play
add("event_minute_counts", "mc", "SELECT * EXCLUDE xg, xg::DOUBLE AS xg FROM mc")
add("team_minute_grid", "grid", "SELECT * EXCLUDE xg, xg::DOUBLE AS xg FROM grid")
add("inplay_rollups", "roll", f"""SELECT match_id, team_id, minute, {', '.join(_real(f'{c}_cum', f'{c}_cum') for c in COUNTS)},
  {', '.join(_real(f'{c}_last_10', f'{c}_last_10') for c in TRAILING)} FROM roll""")
add("inplay_features", "f", "SELECT * FROM f")
add("inplay_slice", "f", f"SELECT * FROM f WHERE {SLICE}")
add("inplay_from_json", "f", "SELECT * FROM f")
add("inplay_derived", "f", """SELECT match_id, minute, (goal_diff_now = 0)::INT AS is_draw_now, abs(goal_diff_now) AS abs_goal_diff_now,
  minute / 90.0::DOUBLE AS minute_progress, goal_diff_now * (minute / 90.0::DOUBLE) AS score_pressure,
  (goal_diff_now = 0 AND minute >= 60)::INT AS late_game_draw, diff_xg_last_10 * (minute / 90.0::DOUBLE) AS xg_pressure_diff,
  diff_shots_last_10 * (minute / 90.0::DOUBLE) AS shots_pressure_diff, diff_passes_cum * (minute / 90.0::DOUBLE) AS passes_pressure_diff,
  CASE target_result_final WHEN 'H' THEN 0 WHEN 'D' THEN 1 ELSE 2 END AS target_code FROM f""")

# ---- pre-game
add("team_perspective", "tp", f"SELECT * EXCLUDE match_date, {_day('match_date')} AS match_date FROM tp")
add("pregame_history", "hist", f"SELECT * EXCLUDE match_date, {_day('match_date')} AS match_date FROM hist")
add("pregame_venue_history", "venue", "SELECT * FROM venue")
add("pregame_distinct_players", "dp", "SELECT * FROM dp")
add("pregame_recent_shots", "rs", "SELECT * FROM rs")
add("pregame_lineup_strength", "ls", "SELECT * FROM ls")
add("pregame_features", "pf", "SELECT * FROM pf")
_N4 = lambda c: f"round({c}::DECIMAL(18,10), 4)::DOUBLE"
add("pregame_short_form", "pf", f"""SELECT match_id, match_date, home_team_id, away_team_id,
  {', '.join(f"{_N4(f'{s}_last5_{k}')} AS {s}_last5_{k}" for s in ('home', 'away') for k in ('points_avg', 'goals_for_avg', 'goals_against_avg', 'win_rate'))},
  {_N4('diff_points_avg')} AS form_diff, {_N4('diff_goals_for_avg')} AS goals_diff, {_N4('diff_goals_against_avg')} AS defense_diff,
  home_days_since_last_match AS home_days_rest, away_days_since_last_match AS away_days_rest, diff_days_rest AS days_rest_diff,
  target_home_win, target_draw, target_away_win, target_over_25, target_btts FROM pf""")
add("pregame_training_rows", "pf", """SELECT * FROM pf WHERE home_matches_played_before >= 5 AND away_matches_played_before >= 5 AND home_fbref_matched_players >= 6 AND away_fbref_matched_players >= 6""")
add("pregame_targets", "tg", "SELECT *, CASE target_result WHEN 'A' THEN 0 WHEN 'D' THEN 1 WHEN 'H' THEN 2 END AS target_code FROM tg")

# ---- statistics
add("match_team_stats", "es", f"""SELECT s.*, {', '.join(f'coalesce({c}, 0) AS {c}' for c in TEAM_COUNTS)}, coalesce(xg, 0)::DOUBLE AS xg,
  round((coalesce(passes_attempted, 0) * 100 / nullif(sum(coalesce(passes_attempted, 0)) OVER (PARTITION BY s.match_id), 0))::DECIMAL(18,10), 2)::DOUBLE AS possession_pct
FROM (SELECT match_id, home_team_id AS team_id, away_team_id AS opponent_team_id, 1 AS is_home, coalesce(home_score, 0) AS goals_scored, coalesce(away_score, 0) AS goals_conceded FROM m
  UNION ALL SELECT match_id, away_team_id, home_team_id, 0, coalesce(away_score, 0), coalesce(home_score, 0) FROM m) s
LEFT JOIN (SELECT match_id, team_id, {', '.join(f'sum({c}) AS {c}' for c in TEAM_COUNTS)}, sum(xg) AS xg FROM es GROUP BY ALL) t
  ON t.match_id = s.match_id AND t.team_id = s.team_id""")
add("match_player_stats", "ps", "SELECT * EXCLUDE xg, xg::DOUBLE AS xg FROM ps")
add("player_season_stats", "ps", f"""SELECT player_id, team_id, competition_id, season_id, count(*) AS matches_played, sum(started) AS starts,
  sum(minutes_played) AS minutes_played, {', '.join(f'sum({c}) AS {c}' for c in SEASON_COUNTS)}, sum(xg)::DOUBLE AS xg
FROM ps JOIN m USING (match_id) GROUP BY player_id, team_id, competition_id, season_id""")
add("shots_by_team", "e", "SELECT match_id, team_name, count(*) AS total_shots FROM e WHERE event_type_name = 'Shot' GROUP BY ALL")

# ---- core tables
add("core_dimensions", "m", f"""SELECT DISTINCT 'competition' AS dimension, competition_id::VARCHAR AS natural_key, competition_name AS name,
  NULL::VARCHAR AS first_day, NULL::VARCHAR AS last_day FROM m
UNION ALL SELECT 'season', competition_name, season_name, {_day('min(match_date)')}, {_day('max(match_date)')} FROM m GROUP BY competition_name, season_name
UNION ALL SELECT DISTINCT 'team', id::VARCHAR, lower(name), NULL, NULL FROM (SELECT home_team_id AS id, home_team_name AS name FROM m UNION SELECT away_team_id, away_team_name FROM m)
UNION ALL SELECT 'coach', '  Coach  OF ' || s_name, 'coach of ' || lower(s_name), NULL, NULL FROM supplier""")
add("core_matches", "m", f"""SELECT match_id::VARCHAR AS source_match_id, competition_name, season_name, {_day('match_date')} AS match_date,
  {_day('match_date')} || ' ' || kick_off[1:5] AS match_datetime, home_team_name AS home_team, away_team_name AS away_team, home_score, away_score, referee_name FROM m""")
add("upsert_replace", "upd", """SELECT * EXCLUDE (k, r) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY k DESC) AS r FROM upd) WHERE r = 1""")
add("insert_if_absent", "upd", """SELECT * EXCLUDE (k, r) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY k) AS r FROM upd) WHERE r = 1""")
add("upsert_coalesce", "upd", """SELECT user_id, event_type, arg_max(value, k) FILTER (value IS NOT NULL) AS value, arg_max(props, k) FILTER (props IS NOT NULL) AS props,
  arg_max(origin, k) AS origin FROM upd GROUP BY user_id, event_type""")
add("delete_insert_season", "m", """SELECT season_name, match_id, 'old' AS version FROM m WHERE season_name <> '2015/2016'
UNION ALL SELECT season_name, match_id + 1, 'new' FROM m WHERE season_name = '2015/2016'""")
add("core_players", "pl", "SELECT * FROM pl")
add("core_teams", "lut st", """SELECT 'statsbomb' AS source_name, id::VARCHAR AS source_team_id, name AS team_name, lower(name) AS normalized_team_name FROM lut
UNION ALL SELECT 'fbref', NULL, p_brand, lower(p_brand) FROM (SELECT DISTINCT p_brand FROM part WHERE p_size <> 50)""")
add("core_lineups", "ll", """SELECT first_position AS position_name, starter, jersey_number, minutes_played, match_id::VARCHAR AS source_match_id,
  lower(team_name) AS normalized_team_name, lower(player_name) AS normalized_player_name
FROM ll QUALIFY row_number() OVER (PARTITION BY match_id, team_id, player_name ORDER BY player_id DESC) = 1""")
add("core_season_stats", "par", """SELECT normalized_player_name, lower(team_name) AS normalized_team_name,
  * EXCLUDE (raw_fbref_player_id, player_name, nationality, age, preferred_position, team_name, competition_name, normalized_player_name)
FROM par WHERE team_name IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY normalized_player_name, team_name ORDER BY raw_fbref_player_id DESC) = 1""")
add("core_events", "e pl", f"""SELECT event_id AS source_event_id, match_id::VARCHAR AS source_match_id, lower(team_name) AS normalized_team_name,
  normalized_player_name, event_index, period, minute, second::DOUBLE AS second, event_type_name,
  '00:' || lpad(coalesce(minute, 0)::VARCHAR, 2, '0') || ':' || lpad(second::VARCHAR, 2, '0') || '.000' AS event_timestamp,
  CASE WHEN l_tax > 0.05 THEN 1 END AS under_pressure,
  CASE WHEN location_size = 2 THEN lx END AS start_x, CASE WHEN location_size = 2 THEN ly END AS start_y,
  CASE WHEN event_type_name = 'Pass' THEN ex END AS end_x, CASE WHEN event_type_name = 'Pass' THEN ey END AS end_y
FROM e JOIN part ON p_partkey = player_id LEFT JOIN pl ON normalized_player_name = lower(p_name || ' ' || p_type)""")

add("core_events_second_load", "e", """SELECT event_id AS source_event_id, event_index, CASE WHEN (l_orderkey * 8 + l_linenumber) % 3 = 1 THEN 99 ELSE event_index END AS possession,
  1 AS has_match, event_id AS raw_payload FROM e""")

add("stored_events_second_load", "e m", """SELECT event_id AS source_event_id, m.season_name, event_index,
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 3 = 1 AND m.season_name = '2015/2016' THEN 99 ELSE event_index END AS possession, event_id AS raw_payload
FROM e JOIN m USING (match_id) WHERE (l_orderkey * 8 + l_linenumber) % 3 > 0 OR m.season_name = '2015/2016'""")
add("stored_lineups_second_load", "ll m", """SELECT first_position AS position_name, starter, CASE WHEN m.season_name = '2015/2016' THEN 77 ELSE jersey_number END AS jersey_number,
  minutes_played, match_id::VARCHAR AS source_match_id, lower(team_name) AS normalized_team_name, lower(player_name) AS normalized_player_name, m.season_name
FROM ll JOIN m USING (match_id) QUALIFY row_number() OVER (PARTITION BY match_id, team_id, player_name ORDER BY player_id DESC) = 1""")

ORACLE["match_team_stats_stored"] = ORACLE["match_team_stats"]
ORACLE["match_player_stats_stored"] = ORACLE["match_player_stats"]

# ---- lookups
add("lookup_with_fallback", "lut", """SELECT match_id, source_id, x.team_name, coalesce(a.id, b.id)::VARCHAR AS found
FROM (SELECT match_id, CASE WHEN match_id % 2 = 0 THEN home_team_id::VARCHAR ELSE 'no such id' END AS source_id,
    CASE WHEN match_id % 5 <> 0 THEN ' ' || upper(away_team_name) END AS team_name FROM m) x
LEFT JOIN lut a ON a.id::VARCHAR = x.source_id LEFT JOIN lut b ON lower(b.name) = lower(trim(x.team_name))""")
add("season_lookup", "m", """SELECT row_id, x.competition_name, x.season_name, coalesce(a.k, b.k) AS season_key, c.competition_name AS competition_found
FROM (SELECT c_custkey AS row_id, CASE WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS competition_name,
    CASE WHEN c_custkey % 7 = 0 THEN '1999/2000' ELSE '2015/2016' END AS season_name FROM customer) x
LEFT JOIN (SELECT DISTINCT competition_name, season_name, competition_name || ':' || season_name AS k FROM m) a
  ON a.competition_name = x.competition_name AND a.season_name = x.season_name
LEFT JOIN (SELECT season_name, min(competition_name || ':' || season_name) AS k FROM m GROUP BY season_name) b ON b.season_name = x.season_name
LEFT JOIN (SELECT DISTINCT competition_name FROM m) c ON lower(c.competition_name) = lower(x.competition_name)""")
add("semi_join_ids", "lp", f"""SELECT match_id::VARCHAR AS source_match_id, count(*) AS lineups FROM lp
WHERE match_id IN (SELECT match_id FROM m WHERE {SLICE}) GROUP BY match_id""")
add("reject_rows", "lp", f"""SELECT CASE WHEN match_id IN (SELECT match_id FROM m WHERE {SLICE}) THEN 'processed' ELSE 'unknown match' END AS status,
  count(*) AS rows FROM lp GROUP BY 1""")
add("unmatched_raw_files", "lp", f"""SELECT {_file('lineups')} AS source_file, count(*) AS lineups FROM lp
WHERE match_id NOT IN (SELECT match_id FROM m WHERE {SLICE}) GROUP BY match_id""")
add("player_team_distinct", "ll par pl", """SELECT DISTINCT 'lineups' AS source, pl.player_name, team_name
FROM ll JOIN pl ON pl.normalized_player_name = lower(ll.player_name)
UNION ALL SELECT DISTINCT 'stats', pl.player_name, team_name FROM par JOIN pl USING (normalized_player_name) WHERE team_name IS NOT NULL""")

# ---- splits and checks
add("temporal_split_rows", "split", f"SELECT match_id, {_day('match_date')} AS match_date, split FROM split")
add("temporal_split_matches", "split", f"""SELECT match_id, {_day('match_date')} AS match_date, match_result, r.minute, split
FROM split, (SELECT unnest(range(1, 91)) AS minute) r""")
add("split_summary", "split", f"""SELECT split, count(*) * 90 AS rows, count(*) AS matches, {_day('min(match_date)')} AS date_min, {_day('max(match_date)')} AS date_max,
  {', '.join(f"count(*) FILTER (match_result = '{c}') * 90 AS n_{c}" for c in 'ADH')} FROM split GROUP BY split""")
add("league_counts", "m", "SELECT competition_name, season_name, count(*) AS total_matches FROM m GROUP BY ALL")
add("competition_counts", "m", "SELECT competition_name, count(*) AS total_matches FROM m GROUP BY ALL")
add("split_competition_counts", "split", "SELECT split, competition_name, count(*) AS matches FROM split GROUP BY ALL")
add("class_distribution", "split", """SELECT split, match_result, count(*) AS rows, count(*) / (sum(count(*)) OVER (PARTITION BY split))::DOUBLE AS share
FROM split GROUP BY split, match_result""")
add("class_shares", "m", "SELECT match_result, count(*) AS rows, count(*) / (sum(count(*)) OVER ())::DOUBLE AS share FROM m GROUP BY match_result")
add("null_counts", "pf", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS nulls FROM pf) WHERE nulls > 0" for c in NUMERIC_FEATURES))
add("layer_counts", "e", " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, count(*) AS rows, count(*) FILTER (event_type_name = 'Shot') AS flagged FROM e" for layer in ("raw", "curated", "silver")))
ORACLE["observed_layer_counts"] = ORACLE["layer_counts"]
add("key_violations", "", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
add("reference_violations", "e", """SELECT match_id, count(*) AS events FROM e
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = player_id AND p_size > 5) GROUP BY match_id""")
add("domain_violations", "e", "SELECT shot_outcome, count(*) AS rows FROM e WHERE shot_outcome NOT IN ('Goal', 'Saved', 'Off T') GROUP BY 1")
add("feature_medians", "pf", " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, median({c}::DOUBLE) AS median, NULL::VARCHAR AS mode FROM pf" for c in NUMERIC_FEATURES]
    + ["(SELECT 'competition_name', NULL, competition_name FROM pf GROUP BY competition_name ORDER BY count(*) DESC, competition_name LIMIT 1)"]))

# ---- metrics
add("confusion_matrix", "sc", f"""SELECT model, label, {', '.join(f"count(*) FILTER (prediction = '{c}') AS pred_{c}" for c in 'ADH')} FROM sc GROUP BY model, label""")
add("classification_report", "sc", """SELECT model, split, class, CASE WHEN pred = 0 THEN 0.0 ELSE tp / pred::DOUBLE END AS precision,
  CASE WHEN support = 0 THEN 0.0 ELSE tp / support::DOUBLE END AS recall,
  CASE WHEN support + pred = 0 THEN 0.0 ELSE 2 * tp / (support + pred)::DOUBLE END AS f1, support
FROM (SELECT model, split, c AS class, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (prediction = c) AS pred,
    count(*) FILTER (label = c) AS support FROM sc, (SELECT unnest(['A', 'D', 'H']) AS c) GROUP BY model, split, c)""")
add("model_metrics", "res", "SELECT * REPLACE (rows::BIGINT AS rows, round(balanced_accuracy, 9) AS balanced_accuracy, round(log_loss, 6) AS log_loss) FROM res")
add("leaderboard", "res", "SELECT model, split, rows::BIGINT AS rows, round(accuracy, 4) AS accuracy, round(log_loss, 4) AS log_loss FROM res")
add("best_model", "res", "SELECT model, split, rows::BIGINT AS rows, round(accuracy, 4) AS accuracy, round(log_loss, 4) AS log_loss FROM res WHERE split = 'test'")

# the greatest of the smallest means over all stretches that hold a score
add("isotonic_steps", "", """WITH p AS (SELECT floor(o_totalprice / 1000) / 1000 AS x, sum((o_orderkey * 7919 % 500000 < o_totalprice)::INT * (o_custkey % 3 + 1)) AS t, sum(o_custkey % 3 + 1) AS w
  FROM orders GROUP BY 1),
c AS (SELECT x, w, row_number() OVER (ORDER BY x) AS i, sum(t) OVER (ORDER BY x) AS ct, sum(w) OVER (ORDER BY x) AS cw FROM p),
z AS (SELECT 0 AS i, 0 AS ct, 0 AS cw UNION ALL SELECT i, ct, cw FROM c),
means AS (SELECT l.i AS a, r.i AS b, (r.ct - l.ct)::DOUBLE / (r.cw - l.cw) AS mean FROM z l JOIN z r ON r.i > l.i),
low AS (SELECT a, b AS i, min(mean) OVER (PARTITION BY a ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS low FROM means),
fit AS (SELECT i, max(low) AS value FROM low GROUP BY i)
SELECT min(x) AS lo, max(x) AS hi, value, sum(w)::DOUBLE AS weight FROM fit JOIN c USING (i) GROUP BY value""")

# ---- serving
_LIST = f"match_id, {_day('match_date')} AS match_date, competition_name, season_name, home_team_name, away_team_name, home_score, away_score"
add("match_list", "m", f"""SELECT {_LIST}, {_day('match_date')} || ' | ' || competition_name || ' | ' || home_team_name || ' vs ' || away_team_name AS label FROM m""")
add("latest_matches", "m", f"""SELECT match_id, {_day('m.match_date')} AS match_date, competition_name, home_team_name, away_team_name
FROM m ORDER BY m.match_date DESC, match_id DESC LIMIT 20""")
add("match_summary", "m", f"SELECT {_LIST}, match_result FROM m WHERE match_id = (SELECT max(match_id) FROM m)")
add("pregame_by_match", "pf", """SELECT * FROM pf WHERE match_id = (SELECT max(c_custkey) FROM customer)""")
add("team_matches", "m", f"""SELECT {_LIST}, match_result FROM m WHERE (SELECT min(home_team_name) FROM m) IN (home_team_name, away_team_name)
ORDER BY m.match_date DESC, match_id DESC LIMIT 5""")
_FORM = """(SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY match_date DESC, match_id DESC) AS position FROM tp)"""
add("recent_form", "tp", f"""SELECT team_id, team_name, position, match_id, {_day('match_date')} AS match_date, is_home, opponent_team_id,
  goals_for, goals_against, form FROM {_FORM} WHERE position <= 5""")
add("form_strip", "tp", f"SELECT team_id, team_name, string_agg(coalesce(form, '-'), '' ORDER BY position) AS form FROM {_FORM} WHERE position <= 5 GROUP BY ALL")
add("form_letters", "m", """SELECT match_id, CASE WHEN home_score > away_score THEN 'W' WHEN home_score = away_score THEN 'D' WHEN home_score < away_score THEN 'L' END AS home_form,
  CASE WHEN home_score < away_score THEN 'W' WHEN home_score = away_score THEN 'D' WHEN home_score > away_score THEN 'L' END AS away_form,
  CASE match_result WHEN 'H' THEN 'Vitória mandante' WHEN 'D' THEN 'Empate' ELSE 'Vitória visitante' END AS label FROM m""")
_CELLS = " UNION ALL ".join(
    f"SELECT match_id, home_team_name, away_team_name, '{name}' AS metric, {h}::DOUBLE AS home_value, {a}::DOUBLE AS away_value FROM pf" for name, (h, a) in COMPARED.items())
add("comparison_unpivot", "pf", _CELLS)
add("comparison_shares", "pf", f"""SELECT match_id, metric, home_value, away_value, home_pct, CASE WHEN t = 0 THEN 50 ELSE greatest(8, 100 - home_pct) END AS away_pct
FROM (SELECT *, CASE WHEN t = 0 THEN 50 ELSE greatest(8, floor(abs(coalesce(home_value, 0)) / nullif(t, 0) * 100)::INT) END AS home_pct
  FROM (SELECT *, abs(coalesce(home_value, 0)) + abs(coalesce(away_value, 0)) AS t FROM ({_CELLS}) WHERE metric IN ({', '.join(f"'{s}'" for s in SHARED)})))""")
add("insights", "pf", """SELECT match_id, row_number() OVER (PARTITION BY match_id ORDER BY rule) - 1 AS position, insight FROM (
SELECT match_id, 1 AS rule, CASE WHEN diff_points_avg > 0.5 THEN home_team_name || ' chega com melhor forma recente em pontos.'
  WHEN diff_points_avg < -0.5 THEN away_team_name || ' chega com melhor forma recente em pontos.'
  WHEN diff_points_avg IS NOT NULL THEN 'A forma recente em pontos indica equilíbrio.' END AS insight FROM pf
UNION ALL SELECT match_id, 2, CASE WHEN diff_goal_diff_avg > 0.3 THEN home_team_name || ' apresenta melhor saldo recente de gols.'
  WHEN diff_goal_diff_avg < -0.3 THEN away_team_name || ' apresenta melhor saldo recente de gols.'
  WHEN diff_goal_diff_avg IS NOT NULL THEN 'O saldo recente de gols está equilibrado.' END FROM pf
UNION ALL SELECT match_id, 3, CASE WHEN diff_shots_on_target_avg > 0.4 THEN home_team_name || ' cria mais volume de chances no alvo.'
  WHEN diff_shots_on_target_avg < -0.4 THEN away_team_name || ' cria mais volume de chances no alvo.' END FROM pf
UNION ALL SELECT match_id, 4, CASE WHEN home_last5_win_rate - away_last5_win_rate > 0.15 THEN home_team_name || ' tem taxa de vitória recente superior.'
  WHEN away_last5_win_rate - home_last5_win_rate > 0.15 THEN away_team_name || ' tem taxa de vitória recente superior.' END FROM pf)
WHERE insight IS NOT NULL""")
add("fair_odds", "sc", f"""SELECT match_id, home_team_name, away_team_name, model, p_A, p_D, p_H, prediction,
  {', '.join(f"1 / p_{c} AS odd_{c}, printf('%.2f', 1 / p_{c}) AS odd_text_{c}" for c in 'HDA')},
  CASE prediction WHEN 'H' THEN 'Vitória mandante' WHEN 'D' THEN 'Empate' ELSE 'Vitória visitante' END AS prediction_label
FROM sc WHERE model = 'no_calibration'""")
add("recommendation_rank", "offers", "SELECT * FROM offers")
add("coupon", "picks", "SELECT * EXCLUDE max_selections FROM picks")
add("coupon_total_odds", "picks", "SELECT user_id, count(*) AS selections, round(product(market_odd), 6) AS total_odd FROM picks GROUP BY user_id")
_IDS = "(3, 7, 11, 42, 77, 101, 120, 149)"
add("export_ids", "m", f"SELECT {_KEYS}, match_result, stadium_id, stadium_name, referee_id, referee_name FROM m WHERE match_id IN {_IDS}")
add("export_inplay", "f", f"SELECT * FROM f WHERE match_id IN {_IDS}")
add("player_mapping", "won", f"""SELECT player_id, player_id::VARCHAR AS statsbomb_player_id, pk.player_name AS statsbomb_player_name, id::VARCHAR AS fbref_player_id,
  qk.player_name AS fbref_player_name, team_name AS statsbomb_team_name, squad_name AS fbref_team_name, '2015/2016' AS season_name, score AS confidence_score,
  {_STATUS} AS mapping_status, 'name/team fuzzy match - score=' || score AS notes
FROM pk JOIN won USING (ln, lt) JOIN qk ON part_key = id WHERE score > 0""")
add("team_mapping", "tm", "SELECT * FROM tm")
add("mapping_counters", "tm", "SELECT mapping_status AS status, count(*) AS rows FROM tm GROUP BY 1 UNION ALL SELECT 'no_match', (SELECT count(*) FROM supplier) - (SELECT count(*) FROM tm)")
