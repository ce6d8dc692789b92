"""Gold mart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators.lookup import bounded
from touchline.plans import gold
from touchline.sources.tables import stored
from touchline.workload import frames
from touchline.workload.frames import ATTENDANCE_SQL, KPIS_SQL, MARKETING_SQL, MATCHES_SQL, PLAYER_MATCH_SQL, key
from touchline.workload.registry import query
from touchline.workload.tables import read_table

_STADIUM_KEY = f"CASE WHEN stadium IS NOT NULL AND city IS NOT NULL THEN {key('stadium', 'city')} END"
_DATE_ID = "strftime({}, '%Y%m%d')::INT"
_DAY = "strftime({}, '%Y-%m-%d')"
_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_DATE_PARTS = f"""{_DAY.format("d")} AS date, {_DATE_ID.format("d")} AS date_id, year(d)::INT AS year,
  month(d)::INT AS month, day(d)::INT AS day, strftime(d, '%a') AS day_of_week"""


def _matches(spark, sf, lines=None):
    return gold.typed_matches(frames.matches_raw(spark, sf, lines))


def _attendance(spark, sf, lines=None):
    return gold.typed_attendance(frames.attendance_raw(spark, sf, lines))


def _kpis(spark, sf):
    return gold.typed_team_kpis(frames.team_kpis_raw(spark, sf))


def _marketing(spark, sf):
    return gold.typed_marketing(frames.marketing_raw(spark, sf))


def _player_match(spark, sf):
    return gold.typed_player_match(frames.player_match_raw(spark, sf))


# --- dimensions -------------------------------------------------------------

@query(f"WITH {KPIS_SQL} SELECT team_name, group_id, team_id FROM teams")
def dim_team(spark, sf):
    return gold.dim_team(_kpis(spark, sf))


@query(f"""
WITH {MATCHES_SQL}
SELECT DISTINCT stadium AS stadium_name, city, {key('stadium', 'city')} AS stadium_id FROM matches
""")
def dim_stadium(spark, sf):
    return gold.dim_stadium(_matches(spark, sf))


@query(f"""
WITH {MATCHES_SQL}
SELECT DISTINCT referee AS referee_name, sha256(referee) AS referee_id FROM matches WHERE referee IS NOT NULL
""")
def dim_referee(spark, sf):
    return gold.dim_referee(_matches(spark, sf))


@query(f"""
WITH {PLAYER_MATCH_SQL}
SELECT player_name, team AS team_name, min(position) AS position, {key('player_name', 'team')} AS player_id
FROM player_match GROUP BY player_name, team
""")
def dim_player_gold(spark, sf):
    return gold.dim_player(_player_match(spark, sf))


@query(f"""
WITH {MARKETING_SQL}
SELECT DISTINCT campaign, sha256(campaign) AS campaign_id FROM marketing WHERE campaign IS NOT NULL
""")
def dim_campaign(spark, sf):
    return gold.dim_campaign(_marketing(spark, sf))


@query(f"WITH {MARKETING_SQL} SELECT DISTINCT channel, sha256(channel) AS channel_id FROM marketing")
def dim_channel(spark, sf):
    return gold.dim_channel(_marketing(spark, sf))


@query(f"""
SELECT {_DATE_PARTS} FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)
""")
def dim_date_from_fact(spark, sf):
    orders = read_table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return gold.dim_date(orders, "day")


@query(f"WITH {MARKETING_SQL} SELECT {_DATE_PARTS} FROM (SELECT DISTINCT date AS d FROM marketing)")
def dim_date_marketing(spark, sf):
    return gold.dim_date(_marketing(spark, sf), "date")


@query(f"""
WITH {MATCHES_SQL}, {ATTENDANCE_SQL}, {KPIS_SQL}, {MARKETING_SQL}, {PLAYER_MATCH_SQL}
SELECT {_DATE_PARTS} FROM (
  SELECT match_date AS d FROM matches UNION SELECT match_date FROM attendance UNION SELECT asof_date FROM kpis
  UNION SELECT date FROM marketing UNION SELECT match_date FROM player_match)
""")
def dim_date_all(spark, sf):
    return gold.dim_date_all({
        "matches": (_matches(spark, sf), "match_date"),
        "attendance": (_attendance(spark, sf), "match_date"),
        "kpis": (_kpis(spark, sf), "asof_date"),
        "marketing": (_marketing(spark, sf), "date"),
        "player_match": (_player_match(spark, sf), "match_date"),
    })


# --- facts ------------------------------------------------------------------

_MATCH_MEASURES = """home_goals, away_goals, home_xg, away_xg, possession_home_pct, shots_home, shots_away,
  shots_on_target_home, shots_on_target_away, cards_yellow_home, cards_yellow_away, cards_red_home, cards_red_away"""


@query(f"""
WITH {MATCHES_SQL}, {KPIS_SQL}
SELECT match_id, {_DATE_ID.format("match_date")} AS match_date_id, {_TIME.format("match_ts")} AS match_ts, stage,
  m.group_id, {_STADIUM_KEY} AS stadium_id, sha256(referee) AS referee_id, h.team_id AS home_team_id,
  a.team_id AS away_team_id, {_MATCH_MEASURES}, attendance
FROM matches m LEFT JOIN teams h ON home_team = h.team_name LEFT JOIN teams a ON away_team = a.team_name
""")
def fact_matches(spark, sf):
    return gold.fact_matches(_matches(spark, sf), stored(gold.dim_team(_kpis(spark, sf)), "dim_team"))


@query(f"""
WITH {MATCHES_SQL}, {ATTENDANCE_SQL},
stadiums AS (SELECT DISTINCT stadium, city, {key('stadium', 'city')} AS stadium_id FROM matches)
SELECT match_id, {_DATE_ID.format("match_date")} AS match_date_id, stadium_id, capacity, attendance, occupancy_pct,
  ticket_price_avg_usd, ticket_revenue_usd, hospitality_revenue_usd, concession_spend_per_capita_usd,
  concession_revenue_usd, security_incidents_count, transport_disruption_minutes, fan_satisfaction_score
FROM attendance a LEFT JOIN stadiums s ON a.stadium = s.stadium AND a.city = s.city
""")
def fact_attendance(spark, sf):
    return gold.fact_attendance(_attendance(spark, sf), stored(gold.dim_stadium(_matches(spark, sf)), "dim_stadium"))


@query(f"""
WITH {KPIS_SQL}
SELECT {_DATE_ID.format("asof_date")} AS asof_date_id, {_DAY.format("asof_date")} AS asof_date, sha256(team) AS team_id,
  group_id, stage, played, points, goals_for, goals_against, goal_diff, xg_for, xg_against, shots_pg,
  shots_on_target_pg, pass_accuracy_pct, possession_pct, pressing_ppda, duels_won_pct, set_piece_xg,
  total_distance_km, injuries_reported
FROM kpis
""")
def fact_team_kpis(spark, sf):
    return gold.fact_team_kpis(_kpis(spark, sf))


@query(f"""
WITH {MARKETING_SQL}
SELECT {_DATE_ID.format("date")} AS date_id, {_DAY.format("date")} AS date, sha256(channel) AS channel_id,
  sha256(campaign) AS campaign_id, metric, region, value, unit
FROM marketing
""")
def fact_marketing(spark, sf):
    return gold.fact_marketing(_marketing(spark, sf))


@query(f"""
WITH {PLAYER_MATCH_SQL}, {KPIS_SQL},
players AS (
  SELECT player_name, team AS team_name, min(position) AS position, {key('player_name', 'team')} AS player_id
  FROM player_match GROUP BY player_name, team)
SELECT match_id, {_DATE_ID.format("match_date")} AS match_date_id, t.team_id, player_id, p.position, minutes, goals,
  assists, shots, shots_on_target, key_passes, passes_completed, dribbles_completed, tackles, interceptions, xg, xa
FROM player_match m LEFT JOIN players p ON m.player_name = p.player_name AND m.team = p.team_name
  LEFT JOIN teams t ON m.team = t.team_name
""")
def player_match_fact(spark, sf):
    rows = _player_match(spark, sf)
    return gold.fact_player_match(rows, gold.dim_player(rows), gold.dim_team(_kpis(spark, sf)))


# --- wide and optional tables -----------------------------------------------

_SIDE = """xg_for AS {0}_xg_for_group, xg_against AS {0}_xg_against_group,
    pass_accuracy_pct AS {0}_pass_accuracy_pct, pressing_ppda AS {0}_pressing_ppda,
    injuries_reported AS {0}_injuries_reported"""


_WIDE_COLUMNS = f"""m.match_id, {_TIME.format("m.match_ts")} AS match_ts, {_DAY.format("m.match_date")} AS match_date, m.stage, m.group_id,
  m.stadium, m.city, home_team, away_team, {_MATCH_MEASURES}, m.attendance, capacity, occupancy_pct,
  ticket_revenue_usd, hospitality_revenue_usd, concession_revenue_usd, fan_satisfaction_score"""
_RESULT = """CASE WHEN home_goals > away_goals THEN 'HOME_WIN' WHEN home_goals < away_goals THEN 'AWAY_WIN'
    ELSE 'DRAW' END AS match_result"""


def _bigtable_sql(sides: str) -> str:
    return f"""
WITH {MATCHES_SQL}, {ATTENDANCE_SQL}, {KPIS_SQL},
sides AS ({sides}),
home AS (SELECT team, {_SIDE.format("home")} FROM sides),
away AS (SELECT team, {_SIDE.format("away")} FROM sides)
SELECT {_WIDE_COLUMNS},
  home.* EXCLUDE (team), away.* EXCLUDE (team),
  {_RESULT}
FROM matches m LEFT JOIN attendance t ON m.match_id = t.match_id
  LEFT JOIN home ON home_team = home.team LEFT JOIN away ON away_team = away.team
"""


@query(_bigtable_sql(
    "SELECT * FROM kpis QUALIFY row_number() OVER (PARTITION BY team ORDER BY asof_date DESC, stage DESC) = 1"
))
def bigtable(spark, sf):
    sides = stored(gold.latest_kpis(_kpis(spark, sf)), "latest_kpis")
    lines = stored(frames.placed_lines(spark, sf), "placed_lines")
    return gold.bigtable(_matches(spark, sf, lines), _attendance(spark, sf, lines), sides)


@query(f"""
WITH {MATCHES_SQL}, {ATTENDANCE_SQL}, {KPIS_SQL},
home AS (SELECT team, asof_date, {_SIDE.format("home")} FROM kpis),
away AS (SELECT team, asof_date, {_SIDE.format("away")} FROM kpis)
SELECT {_WIDE_COLUMNS}, home.* EXCLUDE (team, asof_date), away.* EXCLUDE (team, asof_date), {_RESULT}
FROM matches m LEFT JOIN attendance t ON m.match_id = t.match_id
  ASOF LEFT JOIN home ON home_team = home.team AND m.match_date >= home.asof_date
  ASOF LEFT JOIN away ON away_team = away.team AND m.match_date >= away.asof_date
""")
def kpis_asof(spark, sf):
    """The wide table with each team's KPIs as they stood on the day of the match."""
    lines = bounded(stored(frames.placed_lines(spark, sf, bounded(frames.places_raw(spark, sf))), "placed_lines"))
    return gold.bigtable_asof(_matches(spark, sf, lines), _attendance(spark, sf, lines), _kpis(spark, sf))


@query(f"""
WITH {KPIS_SQL}
SELECT team_id, s_name AS team_name, group_id, (s_nationkey + 1)::INT AS pos, 3 AS played,
  floor(s_acctbal / 1000)::INT AS points
FROM supplier LEFT JOIN teams ON s_name = team_name
""")
def group_standings(spark, sf):
    return gold.group_standings(frames.standings_raw(spark, sf), gold.dim_team(_kpis(spark, sf)))


@query(f"""
WITH {PLAYER_MATCH_SQL}, {KPIS_SQL},
snap AS (
  SELECT player_name, team, min(position) AS position, sum(goals)::INT AS goals, sum(assists)::INT AS assists,
    sum(goals + assists)::INT AS goal_involvements, sum(minutes)::INT AS minutes_played
  FROM player_match GROUP BY player_name, team)
SELECT {key('player_name', 'team')} AS player_id, player_name, team_id, team AS team_name, position, goals, assists,
  goal_involvements, minutes_played
FROM snap LEFT JOIN teams ON team = team_name
""")
def players_snapshot(spark, sf):
    return gold.players_snapshot(frames.snapshot_raw(spark, sf), gold.dim_team(_kpis(spark, sf)))
