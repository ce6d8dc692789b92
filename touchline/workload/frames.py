"""Benchmark tables in the shape of the tournament inputs.

A customer plays for a nation, an order is a match between two suppliers, a
line item is a player's part in a match, an event is a marketing figure. Each
frame has its SQL twin in ``SQL``; both read whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.workload.numeric import exact_sum
from touchline.plans import performance
from touchline.workload.tables import read_table

RUN_TS_TEXT = "2025-01-18 00:00:00"
DAY_TIME = "yyyy-MM-dd HH:mm:ss"


def run_ts() -> Column:
    return F.lit(RUN_TS_TEXT).cast("timestamp")


def _exact(**columns: str) -> list[Column]:
    return [exact_sum(value).alias(name) for name, value in columns.items()]


def _agg(**columns: str) -> list[Column]:
    return [F.expr(value).alias(name) for name, value in columns.items()]


def _some(condition: str) -> str:
    """Count, null when nothing was counted."""
    return f"CAST(nullif(count_if({condition}), 0) AS INT)"


def players_raw(spark: SparkSession, sf: str) -> DataFrame:
    stats = read_table(spark, sf, "orders").groupBy("o_custkey").agg(
        *_agg(
            Goals=_some("o_orderpriority = '1-URGENT'"),
            Assists=_some("o_orderpriority = '2-HIGH'"),
            Tackles=_some("o_orderpriority = '3-MEDIUM'"),
            Interceptions=_some("o_orderpriority = '4-NOT SPECIFIED'"),
            Saves=_some("o_orderpriority = '5-LOW'"),
            Matches_Played=_some("o_orderstatus = 'F'"),
            Clean_Sheets=_some("o_orderstatus = 'O'"),
            Yellow_Cards=_some("o_orderstatus = 'P'"),
            Red_Cards=_some("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"),
            largest="max(o_totalprice)",
            smallest="min(o_totalprice)",
        ),
        *_exact(
            played="if(o_orderstatus = 'F', o_totalprice, NULL)",
            open="if(o_orderstatus = 'O', o_totalprice, NULL)",
        ),
    )
    customer = read_table(spark, sf, "customer")
    return (
        customer.join(stats, F.expr("c_custkey = o_custkey"), "left")
        .join(read_table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "c_name AS Player_Name",
            "n_name AS Country",
            "CAST(nullif(c_custkey % 25 + 16, 40) AS INT) AS Age",
            """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'FW' WHEN 'BUILDING' THEN 'Midfielder'
               WHEN 'FURNITURE' THEN 'DF' WHEN 'HOUSEHOLD' THEN 'Goalkeeper'
               ELSE if(c_acctbal >= 0, c_mktsegment, NULL) END AS Position""",
            "Goals", "Assists",
            "CAST(floor(played / 10000) AS INT) AS Minutes_Played",
            "Matches_Played",
            "floor(largest / 500) / 10 AS Pass_Accuracy",
            "floor(smallest / 1000) / 10 AS Distance_Run_km",
            "floor(open / 100000) / 10 AS Sprint_Speed_kmh",
            "Tackles", "Interceptions", "Saves", "Clean_Sheets", "Yellow_Cards", "Red_Cards",
            "floor((c_acctbal + 1000) / 110) / 10 AS Performance_Rating",
        )
    )


def clean_players(spark: SparkSession, sf: str) -> DataFrame:
    return performance.clean_players(players_raw(spark, sf))


def view(spark: SparkSession, sf: str) -> DataFrame:
    return performance.clean_view(clean_players(spark, sf), run_ts())


def _line_stats(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        *_agg(
            home_key="min(l_suppkey)",
            away_key="max(l_suppkey)",
            part_key="min(l_partkey)",
            shipped="min(l_shipdate)",
            lines="count(1)",
            a="count_if(l_returnflag = 'A')",
            r="count_if(l_returnflag = 'R')",
            n="count_if(l_returnflag = 'N')",
            ao="count_if(l_returnflag = 'A' AND l_linestatus = 'O')",
            ro="count_if(l_returnflag = 'R' AND l_linestatus = 'O')",
            af="count_if(l_returnflag = 'A' AND l_linestatus = 'F')",
            rf="count_if(l_returnflag = 'R' AND l_linestatus = 'F')",
            first_line="count_if(l_linenumber = 1)",
            seventh="count_if(l_linenumber = 7)",
        ),
        *_exact(qty="l_quantity", price="l_extendedprice", disc="l_discount", tax="l_tax"),
    )


def places_raw(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "part").selectExpr("p_partkey AS part_key", "p_brand AS stadium", "p_type AS city")


def placed_lines(spark: SparkSession, sf: str, places: DataFrame | None = None) -> DataFrame:
    """Figures and place of each order's lines, which matches and attendance are both shaped from."""
    return _line_stats(spark, sf).join(places_raw(spark, sf) if places is None else places, "part_key", "left")


def matches_raw(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    team = read_table(spark, sf, "supplier")
    return (
        read_table(spark, sf, "orders")
        .join(placed_lines(spark, sf) if lines is None else lines, F.expr("o_orderkey = l_orderkey"), "left")
        .withColumn("away_key", F.expr("nullif(away_key, home_key)"))
        .join(team.selectExpr("s_suppkey AS home_key", "s_name AS home_team"), "home_key", "left")
        .join(team.selectExpr("s_suppkey AS away_key", "s_name AS away_team"), "away_key", "left")
        .selectExpr(
            "CAST(o_orderkey AS STRING) AS match_id",
            f"""if(o_orderstatus = 'P' AND o_orderpriority = '5-LOW', 'postponed',
                date_format(o_orderdate, '{DAY_TIME}')) AS match_date_utc""",
            "o_orderstatus AS stage", "o_orderpriority AS group_id", "stadium", "city",
            "nullif(o_orderpriority, '5-LOW') AS referee", "home_team", "away_team",
            "a AS home_goals", "r AS away_goals", "disc AS home_xg", "tax AS away_xg",
            "ao * 100.0D / lines AS possession_home_pct",
            "n AS shots_home", "lines AS shots_away",
            "ao AS shots_on_target_home", "ro AS shots_on_target_away",
            "af AS cards_yellow_home", "rf AS cards_yellow_away",
            "first_line AS cards_red_home", "seventh AS cards_red_away",
            "qty AS attendance",
        )
    )


def attendance_raw(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    return (placed_lines(spark, sf) if lines is None else lines).selectExpr(
        "CAST(l_orderkey AS STRING) AS match_id",
        f"date_format(shipped, '{DAY_TIME}') AS match_date_utc",
        "stadium", "city",
        "lines * 50 AS capacity",
        "qty AS attendance",
        "qty * 100.0D / (lines * 50) AS occupancy_pct",
        "price / qty AS ticket_price_avg_usd",
        "price AS ticket_revenue_usd",
        "disc AS hospitality_revenue_usd",
        "tax AS concession_spend_per_capita_usd",
        "tax * qty AS concession_revenue_usd",
        "r AS security_incidents_count",
        "n AS transport_disruption_minutes",
        "price / (lines * 10000.0D) AS fan_satisfaction_score",
    )


def team_kpis_raw(spark: SparkSession, sf: str) -> DataFrame:
    months = read_table(spark, sf, "lineitem").groupBy(
        "l_suppkey", F.expr("last_day(l_shipdate)").alias("asof")
    ).agg(
        *_agg(
            played="count(1)",
            a="count_if(l_returnflag = 'A')",
            r="count_if(l_returnflag = 'R')",
            n="count_if(l_returnflag = 'N')",
            top="max(l_discount)",
            seventh="count_if(l_linenumber = 7)",
        ),
        *_exact(qty="l_quantity", price="l_extendedprice", disc="l_discount", tax="l_tax"),
    )
    return (
        months.join(read_table(spark, sf, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(read_table(spark, sf, "nation"), F.expr("s_nationkey = n_nationkey"))
        .selectExpr(
            "s_name AS team", "n_name AS group_id",
            "if(month(asof) <= 6, 'Group', 'Knockout') AS stage",
            "date_format(asof, 'yyyy-MM-dd') AS asof_date",
            "played", "a * 3 + n AS points", "a AS goals_for", "r AS goals_against", "a - r AS goal_diff",
            "disc AS xg_for", "tax AS xg_against",
            "qty / played AS shots_pg", "a / played AS shots_on_target_pg",
            "disc * 100.0D / played AS pass_accuracy_pct", "tax * 100.0D / played AS possession_pct",
            "price / qty AS pressing_ppda", "a * 100.0D / played AS duels_won_pct",
            "top + 0.0D AS set_piece_xg", "price / 1000.0D AS total_distance_km",
            "seventh AS injuries_reported",
        )
    )


def marketing_raw(spark: SparkSession, sf: str) -> DataFrame:
    k = F.expr("CAST(get_json_object(props, '$.k') AS INT)")
    return read_table(spark, sf, "events").withColumn("k", k).selectExpr(
        f"date_format(ts, '{DAY_TIME}') AS date_utc",
        "event_type AS channel",
        "if(k < 80, concat('campaign-', k), NULL) AS campaign",
        "if(value >= 10, 'spend', 'reach') AS metric",
        "concat('region-', user_id % 10) AS region",
        "value",
        "'usd' AS unit",
    )


def player_match_raw(spark: SparkSession, sf: str) -> DataFrame:
    return (
        read_table(spark, sf, "lineitem")
        .join(read_table(spark, sf, "part"), F.expr("l_partkey = p_partkey"))
        .join(read_table(spark, sf, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .selectExpr(
            "CAST(l_orderkey AS STRING) AS match_id",
            f"date_format(l_shipdate, '{DAY_TIME}') AS match_date_utc",
            "p_name AS player_name", "s_name AS team", "p_type AS position",
            "l_quantity AS minutes",
            "CAST(l_returnflag = 'A' AS INT) AS goals", "CAST(l_returnflag = 'R' AS INT) AS assists",
            "l_linenumber AS shots", "l_linenumber % 3 AS shots_on_target",
            "CAST(l_linestatus = 'O' AS INT) AS key_passes",
            "p_size AS passes_completed",
            "floor(l_extendedprice / 10000) AS dribbles_completed",
            "floor(l_discount * 100) AS tackles", "floor(l_tax * 100) AS interceptions",
            "l_discount + 0.0D AS xg", "l_tax + 0.0D AS xa",
        )
    )


def standings_raw(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "supplier").selectExpr(
        "s_name AS team", "CAST(s_nationkey + 1 AS STRING) AS pos", "'3' AS played",
        "CAST(floor(s_acctbal / 1000) AS STRING) AS points",
    )


def snapshot_raw(spark: SparkSession, sf: str) -> DataFrame:
    return player_match_raw(spark, sf).groupBy("player_name", "team").agg(
        *_agg(position="min(position)", goals="sum(goals)", assists="sum(assists)",
              goal_involvements="sum(goals + assists)"),
        *_exact(minutes_played="minutes"),
    )


def exact(expression: str) -> str:
    """SQL of ``numeric.exact_sum``."""
    return f"sum(({expression})::DECIMAL(24,6))::DOUBLE"


def mean(expression: str) -> str:
    """SQL of a mean as ``numeric.comparable`` shows it."""
    return f"floor(avg(({expression})::DOUBLE) * 10000 + 0.5001) / 10000"


def key(*columns: str) -> str:
    """SQL of ``functions.keys.composite_key``."""
    parts = ", ".join(f"coalesce(({c})::VARCHAR, '\\N')" for c in columns)
    return f"sha256(concat_ws('|', {parts}))"


def _some_sql(condition: str) -> str:
    return f"nullif(count(*) FILTER (WHERE {condition}), 0)::INT"


_COUNT = "count(*) FILTER (WHERE {})"

PLAYERS_SQL = f"""
player_stats AS (
  SELECT o_custkey,
    {_some_sql("o_orderpriority = '1-URGENT'")} AS goals,
    {_some_sql("o_orderpriority = '2-HIGH'")} AS assists,
    {exact("CASE WHEN o_orderstatus = 'F' THEN o_totalprice END")} AS played,
    {_some_sql("o_orderstatus = 'F'")} AS matches,
    max(o_totalprice) AS largest, min(o_totalprice) AS smallest,
    {exact("CASE WHEN o_orderstatus = 'O' THEN o_totalprice END")} AS open_price,
    {_some_sql("o_orderpriority = '3-MEDIUM'")} AS tackles,
    {_some_sql("o_orderpriority = '4-NOT SPECIFIED'")} AS interceptions,
    {_some_sql("o_orderpriority = '5-LOW'")} AS saves,
    {_some_sql("o_orderstatus = 'O'")} AS clean_sheets,
    {_some_sql("o_orderstatus = 'P'")} AS yellow_cards,
    {_some_sql("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")} AS red_cards
  FROM orders GROUP BY o_custkey
),
players_raw AS (
  SELECT c_name AS "Player_Name", n_name AS "Country",
    CASE WHEN c_custkey % 25 + 16 < 40 THEN (c_custkey % 25 + 16)::INT END AS "Age",
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'FW' WHEN c_mktsegment = 'BUILDING' THEN 'Midfielder'
         WHEN c_mktsegment = 'FURNITURE' THEN 'DF' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Goalkeeper'
         WHEN c_acctbal >= 0 THEN c_mktsegment END AS "Position",
    goals AS "Goals", assists AS "Assists", floor(played / 10000)::INT AS "Minutes_Played",
    matches AS "Matches_Played", floor(largest / 500) / 10 AS "Pass_Accuracy",
    floor(smallest / 1000) / 10 AS "Distance_Run_km", floor(open_price / 100000) / 10 AS "Sprint_Speed_kmh",
    tackles AS "Tackles", interceptions AS "Interceptions", saves AS "Saves",
    clean_sheets AS "Clean_Sheets", yellow_cards AS "Yellow_Cards", red_cards AS "Red_Cards",
    floor((c_acctbal + 1000) / 110) / 10 AS "Performance_Rating"
  FROM customer LEFT JOIN player_stats ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

CLEAN_SQL = f"""{PLAYERS_SQL},
clean AS (
  SELECT "Player_Name", "Country", "Age",
    CASE WHEN "Position" IN ('Forward', 'FW') THEN 'Forward' WHEN "Position" IN ('Midfielder', 'MF') THEN 'Midfielder'
         WHEN "Position" IN ('Defender', 'DF') THEN 'Defender' WHEN "Position" IN ('Goalkeeper', 'GK') THEN 'Goalkeeper'
         ELSE "Position" END AS "Position",
    coalesce("Goals", 0) AS "Goals", coalesce("Assists", 0) AS "Assists",
    coalesce("Minutes_Played", 0) AS "Minutes_Played", coalesce("Matches_Played", 0) AS "Matches_Played",
    coalesce("Pass_Accuracy", 0) AS "Pass_Accuracy", coalesce("Distance_Run_km", 0) AS "Distance_Run_km",
    coalesce("Sprint_Speed_kmh", 0) AS "Sprint_Speed_kmh", coalesce("Tackles", 0) AS "Tackles",
    coalesce("Interceptions", 0) AS "Interceptions", coalesce("Saves", 0) AS "Saves",
    coalesce("Clean_Sheets", 0) AS "Clean_Sheets", coalesce("Yellow_Cards", 0) AS "Yellow_Cards",
    coalesce("Red_Cards", 0) AS "Red_Cards", coalesce("Performance_Rating", 0) AS "Performance_Rating",
    coalesce("Minutes_Played", 0) > 0 AS is_active
  FROM players_raw
  WHERE "Player_Name" IS NOT NULL AND "Country" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY "Player_Name", "Country" ORDER BY "Age" NULLS FIRST, "Position" NULLS FIRST) = 1
)"""

VIEW_SQL = f"""{CLEAN_SQL},
star AS (
  SELECT {key('"Player_Name"', '"Country"', '20250103')} AS performance_id,
    {key('"Player_Name"', '"Country"')} AS player_id,
    sha256("Country") AS country_id,
    sha256(coalesce("Position", 'Unknown')) AS position_id,
    20250103 AS date_id,
    "Goals" AS goals, "Assists" AS assists, "Pass_Accuracy" AS pass_accuracy_pct,
    "Minutes_Played" AS minutes_played, "Matches_Played" AS matches_played,
    "Distance_Run_km" AS distance_run_km, "Sprint_Speed_kmh" AS sprint_speed_kmh,
    "Tackles" AS tackles, "Interceptions" AS interceptions, "Saves" AS saves,
    "Clean_Sheets" AS clean_sheets, "Yellow_Cards" AS yellow_cards, "Red_Cards" AS red_cards,
    "Performance_Rating" AS performance_rating, "Goals" + "Assists" AS goal_contributions,
    CASE WHEN "Matches_Played" > 0 THEN "Minutes_Played"::DOUBLE / "Matches_Played" ELSE 0.0::DOUBLE END AS avg_minutes_per_match,
    CASE WHEN "Matches_Played" > 0 THEN "Goals"::DOUBLE / "Matches_Played" ELSE 0.0::DOUBLE END AS goals_per_match,
    is_active, '{RUN_TS_TEXT}' AS created_at,
    "Player_Name" AS player_name, "Age" AS age, coalesce("Position", 'Unknown') AS position_name,
    "Country" AS country_name
  FROM clean
)"""

SHOWN_SQL = f"""{VIEW_SQL},
shown AS (
  SELECT * FROM star WHERE age <= 28 AND performance_rating >= 8.0 AND minutes_played > 0
)"""

LINES_SQL = f"""
line_stats AS (
  SELECT l_orderkey, min(l_suppkey) AS home_key, max(l_suppkey) AS away_key, min(l_partkey) AS part_key,
    min(l_shipdate) AS shipped, count(*) AS lines, {exact("l_quantity")} AS qty,
    {exact("l_extendedprice")} AS price, {exact("l_discount")} AS disc, {exact("l_tax")} AS tax,
    {_COUNT.format("l_returnflag = 'A'")} AS a, {_COUNT.format("l_returnflag = 'R'")} AS r,
    {_COUNT.format("l_returnflag = 'N'")} AS n,
    {_COUNT.format("l_returnflag = 'A' AND l_linestatus = 'O'")} AS ao,
    {_COUNT.format("l_returnflag = 'R' AND l_linestatus = 'O'")} AS ro,
    {_COUNT.format("l_returnflag = 'A' AND l_linestatus = 'F'")} AS af,
    {_COUNT.format("l_returnflag = 'R' AND l_linestatus = 'F'")} AS rf,
    {_COUNT.format("l_linenumber = 1")} AS first_line, {_COUNT.format("l_linenumber = 7")} AS seventh
  FROM lineitem GROUP BY l_orderkey
)"""

MATCHES_SQL = f"""{LINES_SQL},
matches AS (
  SELECT o_orderkey::VARCHAR AS match_id,
    CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') THEN o_orderdate END AS match_ts,
    match_ts::DATE AS match_date,
    o_orderstatus AS stage, o_orderpriority AS group_id, p_brand AS stadium, p_type AS city,
    nullif(o_orderpriority, '5-LOW') AS referee, h.s_name AS home_team, w.s_name AS away_team,
    a::INT AS home_goals, r::INT AS away_goals, disc AS home_xg, tax AS away_xg,
    ao * 100.0::DOUBLE / lines AS possession_home_pct, n::INT AS shots_home, lines::INT AS shots_away,
    ao::INT AS shots_on_target_home, ro::INT AS shots_on_target_away, af::INT AS cards_yellow_home,
    rf::INT AS cards_yellow_away, first_line::INT AS cards_red_home, seventh::INT AS cards_red_away,
    trunc(qty)::INT AS attendance
  FROM orders LEFT JOIN line_stats ON o_orderkey = l_orderkey
    LEFT JOIN part ON part_key = p_partkey
    LEFT JOIN supplier h ON h.s_suppkey = home_key
    LEFT JOIN supplier w ON w.s_suppkey = nullif(away_key, home_key)
)"""

ATTENDANCE_SQL = """
attendance AS (
  SELECT l_orderkey::VARCHAR AS match_id, shipped AS match_ts, shipped::DATE AS match_date,
    p_brand AS stadium, p_type AS city, (lines * 50)::INT AS capacity, trunc(qty)::INT AS attendance,
    qty * 100.0::DOUBLE / (lines * 50) AS occupancy_pct, price / qty AS ticket_price_avg_usd,
    price AS ticket_revenue_usd, disc AS hospitality_revenue_usd, tax AS concession_spend_per_capita_usd,
    tax * qty AS concession_revenue_usd, r::INT AS security_incidents_count,
    n::INT AS transport_disruption_minutes, price / (lines * 10000.0::DOUBLE) AS fan_satisfaction_score
  FROM line_stats LEFT JOIN part ON part_key = p_partkey
)"""

KPIS_SQL = f"""
kpi_months AS (
  SELECT l_suppkey, last_day(l_shipdate) AS asof_date, count(*) AS played,
    {_COUNT.format("l_returnflag = 'A'")} AS a, {_COUNT.format("l_returnflag = 'R'")} AS r,
    {_COUNT.format("l_returnflag = 'N'")} AS n, {exact("l_quantity")} AS qty,
    {exact("l_extendedprice")} AS price, {exact("l_discount")} AS disc, {exact("l_tax")} AS tax,
    max(l_discount) AS top_discount, {_COUNT.format("l_linenumber = 7")} AS seventh
  FROM lineitem GROUP BY ALL
),
kpis AS (
  SELECT s_name AS team, n_name AS group_id,
    CASE WHEN month(asof_date) <= 6 THEN 'Group' ELSE 'Knockout' END AS stage, asof_date,
    played::INT AS played, (a * 3 + n)::INT AS points, a::INT AS goals_for, r::INT AS goals_against,
    (a - r)::INT AS goal_diff, disc AS xg_for, tax AS xg_against, qty / played AS shots_pg,
    a::DOUBLE / played AS shots_on_target_pg, disc * 100.0::DOUBLE / played AS pass_accuracy_pct,
    tax * 100.0::DOUBLE / played AS possession_pct, price / qty AS pressing_ppda,
    a * 100.0::DOUBLE / played AS duels_won_pct, top_discount + 0.0::DOUBLE AS set_piece_xg,
    price / 1000.0::DOUBLE AS total_distance_km, seventh::INT AS injuries_reported
  FROM kpi_months JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
teams AS (
  SELECT team AS team_name, min(group_id) AS group_id, sha256(team) AS team_id FROM kpis GROUP BY team
)"""

MARKETING_SQL = """
marketing AS (
  SELECT ts::DATE AS date, event_type AS channel,
    CASE WHEN json_extract_string(props, '$.k')::INT < 80
         THEN 'campaign-' || json_extract_string(props, '$.k') END AS campaign,
    CASE WHEN value >= 10 THEN 'spend' ELSE 'reach' END AS metric,
    'region-' || (user_id % 10) AS region, value, 'usd' AS unit
  FROM events
)"""

PLAYER_MATCH_SQL = """
player_match AS (
  SELECT l_orderkey::VARCHAR AS match_id, l_shipdate::DATE AS match_date, p_name AS player_name,
    s_name AS team, p_type AS position, trunc(l_quantity)::INT AS minutes,
    (l_returnflag = 'A')::INT AS goals, (l_returnflag = 'R')::INT AS assists, l_linenumber AS shots,
    l_linenumber % 3 AS shots_on_target, (l_linestatus = 'O')::INT AS key_passes,
    p_size AS passes_completed, floor(l_extendedprice / 10000)::INT AS dribbles_completed,
    floor(l_discount * 100)::INT AS tackles, floor(l_tax * 100)::INT AS interceptions,
    l_discount + 0.0::DOUBLE AS xg, l_tax + 0.0::DOUBLE AS xa
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
)"""
