"""Performance mart and dashboard panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.plans import panels, performance
from touchline.workload.frames import CLEAN_SQL, SHOWN_SQL, VIEW_SQL, clean_players, exact, mean, run_ts, view
from touchline.workload.registry import query

_FACT_COLUMNS = """performance_id, player_id, country_id, position_id, date_id, goals, assists, pass_accuracy_pct,
  minutes_played, matches_played, distance_run_km, sprint_speed_kmh, tackles, interceptions, saves, clean_sheets,
  yellow_cards, red_cards, performance_rating, goal_contributions, avg_minutes_per_match, goals_per_match,
  is_active, created_at"""


@query(f"""WITH {CLEAN_SQL} SELECT * FROM clean""")
def clean_player_rows(spark, sf):
    return clean_players(spark, sf)


@query(f"""
WITH {VIEW_SQL}
SELECT player_id, player_name, age, nullif(position_name, 'Unknown') AS position, created_at, created_at AS updated_at
FROM star
""")
def dim_player(spark, sf):
    return performance.dim_player(clean_players(spark, sf), run_ts())


@query(f"WITH {VIEW_SQL} SELECT DISTINCT country_id, country_name, created_at FROM star")
def dim_country(spark, sf):
    return performance.dim_country(clean_players(spark, sf), run_ts())


@query(f"""
WITH {VIEW_SQL}
SELECT DISTINCT position_id, position_name, CASE position_name WHEN 'Forward' THEN 'Attack'
  WHEN 'Midfielder' THEN 'Midfield' WHEN 'Defender' THEN 'Defense' WHEN 'Goalkeeper' THEN 'Defense'
  ELSE 'Unknown' END AS position_category, created_at
FROM star
""")
def dim_position(spark, sf):
    return performance.dim_position(clean_players(spark, sf), run_ts())


@query(f"WITH {VIEW_SQL} SELECT {_FACT_COLUMNS} FROM star")
def fact_performance(spark, sf):
    return performance.fact_performance(clean_players(spark, sf), run_ts())


@query(f"WITH {VIEW_SQL} SELECT {_FACT_COLUMNS}, player_name, age, position_name, country_name FROM star")
def star_tables_joined(spark, sf):
    """The panel view from stored star tables: fact joined to three dimensions."""
    clean = clean_players(spark, sf)
    return performance.star_view(
        performance.fact_performance(clean, run_ts()),
        performance.dim_player(clean, run_ts()),
        performance.dim_country(clean, run_ts()),
        performance.dim_position(clean, run_ts()),
    )


@query(f"""
WITH {VIEW_SQL}
SELECT country_id, country_name, count(*) AS total_players, sum(goals)::BIGINT AS total_goals,
  sum(assists)::BIGINT AS total_assists, {mean("performance_rating")} AS avg_rating,
  sum(minutes_played)::BIGINT AS total_minutes, sum(yellow_cards)::BIGINT AS total_yellow_cards,
  sum(red_cards)::BIGINT AS total_red_cards, {mean("pass_accuracy_pct")} AS avg_pass_accuracy,
  max(created_at) AS created_at
FROM star GROUP BY country_id, country_name
""", means=("avg_rating", "avg_pass_accuracy"))
def agg_country(spark, sf):
    clean = clean_players(spark, sf)
    fact = performance.fact_performance(clean, run_ts())
    return performance.agg_country(fact, performance.dim_country(clean, run_ts()), run_ts())


@query(f"""
WITH {VIEW_SQL}
SELECT position_id, position_name, count(*) AS total_players, {mean("performance_rating")} AS avg_rating,
  {mean("goals")} AS avg_goals, {mean("assists")} AS avg_assists, {mean("sprint_speed_kmh")} AS avg_sprint_speed,
  {mean("distance_run_km")} AS avg_distance_run, max(performance_rating) AS max_rating, max(created_at) AS created_at
FROM star GROUP BY position_id, position_name
""", means=("avg_rating", "avg_goals", "avg_assists", "avg_sprint_speed", "avg_distance_run"))
def agg_position(spark, sf):
    clean = clean_players(spark, sf)
    fact = performance.fact_performance(clean, run_ts())
    return performance.agg_position(fact, performance.dim_position(clean, run_ts()), run_ts())


@query(f"""
WITH {VIEW_SQL}
SELECT row_number() OVER (ORDER BY performance_rating DESC, performance_id)::INT AS rank, player_name, country_name,
  performance_rating, goals, assists, goal_contributions, created_at
FROM star ORDER BY rank LIMIT 50
""")
def top_performers(spark, sf):
    clean = clean_players(spark, sf)
    return performance.top_performers(
        performance.fact_performance(clean, run_ts()),
        performance.dim_player(clean, run_ts()),
        performance.dim_country(clean, run_ts()),
        run_ts(),
    )


# --- panels -----------------------------------------------------------------

@query(f"WITH {SHOWN_SQL} SELECT 0 AS time, 'Total Goals' AS metric, sum(goals)::BIGINT AS value FROM shown")
def panel_total_goals(spark, sf):
    return panels.total_goals(view(spark, sf))


@query(f"WITH {SHOWN_SQL} SELECT 0 AS time, 'Total Assists' AS metric, sum(assists)::BIGINT AS value FROM shown")
def panel_total_assists(spark, sf):
    return panels.total_assists(view(spark, sf))


@query(f"WITH {SHOWN_SQL} SELECT 0 AS time, 'Total Players' AS metric, count(DISTINCT player_id) AS value FROM shown")
def panel_total_players(spark, sf):
    return panels.total_players(view(spark, sf))


@query(f"""
WITH {SHOWN_SQL} SELECT 0 AS time, 'Avg Performance Rating' AS metric, {mean("performance_rating")} AS value FROM shown
""", means=("value",))
def panel_avg_rating(spark, sf):
    return panels.avg_rating(view(spark, sf))


@query(f"""
WITH {SHOWN_SQL}
SELECT 0 AS time, position_name AS metric, {mean("performance_rating")} AS value FROM shown GROUP BY position_name
""", means=("value",))
def panel_rating_by_position(spark, sf):
    return panels.rating_by_position(view(spark, sf))


@query(f"""
WITH {SHOWN_SQL}
SELECT 0 AS time, player_name AS metric, goal_contributions AS value FROM shown
ORDER BY goal_contributions DESC, player_name, performance_id LIMIT 10
""")
def panel_top10(spark, sf):
    return panels.top_contributors(view(spark, sf))


@query(f"""
WITH {SHOWN_SQL}
SELECT 0 AS time, country_name AS metric, count(*) AS value FROM shown GROUP BY country_name
ORDER BY value DESC, metric LIMIT 10
""")
def panel_country_count(spark, sf):
    return panels.country_count(view(spark, sf))


@query(f"""
WITH {SHOWN_SQL}
SELECT 0 AS time, position_name AS metric, count(*) AS value,
  count(*) * 100.0::DOUBLE / (SELECT count(*) FROM shown) AS percent
FROM shown GROUP BY position_name
""")
def panel_position_share(spark, sf):
    return panels.position_share(view(spark, sf))


_TOP_COUNTRIES_SQL = f"""{SHOWN_SQL},
top_countries AS (
  SELECT 0 AS time, country_name AS metric, count(DISTINCT player_id) AS value FROM shown
  WHERE country_name IN (
    SELECT country_name FROM star GROUP BY country_name
    ORDER BY count(DISTINCT player_id) DESC, country_name LIMIT 5)
  GROUP BY country_name
)"""


@query(f"WITH {_TOP_COUNTRIES_SQL} SELECT * FROM top_countries")
def panel_top5_countries(spark, sf):
    return panels.top_countries(view(spark, sf))


@query(f"""
WITH {SHOWN_SQL} SELECT 0 AS time, position_name AS metric, count(*) AS value FROM shown GROUP BY position_name
""")
def panel_position_count(spark, sf):
    return panels.position_count(view(spark, sf))


@query(f"""
WITH {SHOWN_SQL}
SELECT row_number() OVER (ORDER BY performance_rating DESC, performance_id)::INT AS "Rank",
  player_name AS "Player Name", country_name AS "Country", age AS "Age", position_name AS "Position",
  performance_rating AS "Performance Rating", goals AS "Goals", assists AS "Assists",
  goal_contributions AS "Total Contributions", pass_accuracy_pct AS "Pass %", minutes_played AS "Minutes",
  distance_run_km AS "Distance (km)", tackles AS "Tackles", interceptions AS "Interceptions",
  yellow_cards AS "Yellows", red_cards AS "Reds", created_at AS "Updated At"
FROM shown ORDER BY "Rank" LIMIT 15
""")
def panel_ranking(spark, sf):
    return panels.ranking(view(spark, sf))


@query(f"""
WITH {SHOWN_SQL}
SELECT country_name AS "Country", count(DISTINCT player_id) AS "Total Players",
  {mean("performance_rating")} AS "Avg Rating", sum(goals)::BIGINT AS "Total Goals",
  sum(assists)::BIGINT AS "Total Assists", {mean("pass_accuracy_pct")} AS "Avg Pass Accuracy %",
  sum(minutes_played)::BIGINT AS "Total Minutes", sum(tackles)::BIGINT AS "Tackles",
  sum(interceptions)::BIGINT AS "Interceptions", sum(yellow_cards)::BIGINT AS "Yellow Cards",
  sum(red_cards)::BIGINT AS "Red Cards", max(created_at) AS "Updated At"
FROM shown GROUP BY country_name ORDER BY "Avg Rating" DESC, "Country" LIMIT 15
""", means=("Avg Rating", "Avg Pass Accuracy %"))
def panel_country_table(spark, sf):
    return panels.country_table(view(spark, sf))


@query(f"""
WITH {VIEW_SQL}
SELECT 0 AS time, 'Total Goals' AS metric, sum(goals)::BIGINT AS value FROM star
WHERE position_name = 'Forward' AND age <= 32 AND performance_rating >= 7.0 AND minutes_played > 0
""")
def panel_forward_goals(spark, sf):
    """A panel with other variables than the defaults."""
    return panels.total_goals(view(spark, sf), panels.Variables("Forward", 32, 7.0))


def _ladder(value: str, steps) -> str:
    cases = " ".join(f"WHEN {value} >= {t} THEN '{label}'" for t, label in reversed(steps))
    return f"CASE WHEN {value} IS NULL THEN NULL {cases} ELSE '{steps[0][1]}' END"


@query(f"""
WITH {_TOP_COUNTRIES_SQL},
stats AS (
  SELECT sum(goals)::DOUBLE AS g, sum(assists)::DOUBLE AS a, count(DISTINCT player_id)::DOUBLE AS p,
    {mean("performance_rating")} AS r FROM shown),
ranged AS (
  SELECT metric, value::DOUBLE AS value, CASE WHEN max(value) OVER () > min(value) OVER ()
    THEN (value - min(value) OVER ()) * 100.0::DOUBLE / (max(value) OVER () - min(value) OVER ()) ELSE 100.0 END AS percent
  FROM top_countries)
SELECT 'Total Goals' AS metric, g AS value, {_ladder("g", fv.TOTAL_GOALS_STEPS)} AS band FROM stats
UNION ALL SELECT 'Total Assists', a, {_ladder("a", fv.TOTAL_ASSISTS_STEPS)} FROM stats
UNION ALL SELECT 'Total Players', p, {_ladder("p", fv.TOTAL_PLAYERS_STEPS)} FROM stats
UNION ALL SELECT 'Avg Performance Rating', r, {_ladder("r", fv.AVG_RATING_STEPS)} FROM stats
UNION ALL SELECT metric, value, {_ladder("percent", fv.COUNTRY_GAUGE_PERCENT_STEPS)} FROM ranged
""", means=("value",))
def threshold_band(spark, sf):
    star = view(spark, sf)
    gauge = panels.with_percent_band(panels.top_countries(star))
    return panels.headline_stats(star).select("metric", "value", "band").unionByName(
        gauge.select("metric", F.col("value").cast("double").alias("value"), "band")
    )


@query(f"""
WITH {VIEW_SQL}
SELECT DISTINCT position_name AS __text, position_name AS __value FROM star UNION ALL SELECT 'All', 'All'
""")
def variable_options(spark, sf):
    return panels.position_options(performance.dim_position(clean_players(spark, sf), run_ts()))


@query(f"""
WITH {VIEW_SQL}
SELECT max_age, min_rating, count(*) AS total_rows, sum(goals)::BIGINT AS total_goals,
  sum(assists)::BIGINT AS total_assists
FROM star JOIN (VALUES (23), (28), (32), (99)) AS a(max_age) ON age <= max_age
  JOIN (VALUES (7.0::DOUBLE), (7.5::DOUBLE), (8.0::DOUBLE), (8.5::DOUBLE)) AS r(min_rating)
    ON performance_rating >= min_rating
WHERE minutes_played > 0 GROUP BY max_age, min_rating
""")
def static_options(spark, sf):
    """Totals for every choice of the two fixed option lists."""
    return panels.option_grid(view(spark, sf))
