"""Fixed values of the tournament data model.

Everything here is a name, bound, pattern or format that other systems rely on
(input headers, table layouts, key formats, dashboard settings). The values are
plain text in their natural order; no logic lives in this file.
"""

# Header and types of the player performance file.
PLAYER_SCHEMA = """
    Player_Name STRING, Country STRING, Age INT, Position STRING,
    Goals INT, Assists INT, Minutes_Played INT, Matches_Played INT,
    Pass_Accuracy DOUBLE, Distance_Run_km DOUBLE, Sprint_Speed_kmh DOUBLE,
    Tackles INT, Interceptions INT, Saves INT, Clean_Sheets INT,
    Yellow_Cards INT, Red_Cards INT, Performance_Rating DOUBLE
"""

# Natural key of a player row, and the defaults for missing numbers.
PLAYER_KEY = ["Player_Name", "Country"]
ZERO_INT_COLUMNS = [
    "Goals", "Assists", "Minutes_Played", "Matches_Played", "Tackles",
    "Interceptions", "Saves", "Clean_Sheets", "Yellow_Cards", "Red_Cards",
]
ZERO_DOUBLE_COLUMNS = [
    "Pass_Accuracy", "Distance_Run_km", "Sprint_Speed_kmh", "Performance_Rating",
]

# Spellings of each position, and the line a position belongs to.
POSITION_ALIASES = {
    "Forward": ["Forward", "FW"],
    "Midfielder": ["Midfielder", "MF"],
    "Defender": ["Defender", "DF"],
    "Goalkeeper": ["Goalkeeper", "GK"],
}
POSITION_CATEGORY = {
    "Forward": "Attack",
    "Midfielder": "Midfield",
    "Defender": "Defense",
    "Goalkeeper": "Defense",
}
UNKNOWN = "Unknown"

# The data-quality suite for player rows.
REQUIRED_COLUMNS = ["Player_Name", "Country", "Age", "Position", "Performance_Rating"]
NOT_NULL_COLUMNS = ["Player_Name", "Country"]
VALUE_BOUNDS = {
    "Age": (15, 50),
    "Performance_Rating": (0, 10),
    "Minutes_Played": (0, None),
    "Goals": (0, None),
}
ALLOWED_POSITIONS = ["Forward", "Midfielder", "Defender", "Goalkeeper", "FW", "MF", "DF", "GK"]

# Tournament calendar and the date the player file is booked on.
CALENDAR_START = "2024-12-21"
CALENDAR_END = "2025-01-18"
PERFORMANCE_DATE_ID = 20250103

# fact_performance column -> player file column.
PERFORMANCE_MEASURES = {
    "goals": "Goals",
    "assists": "Assists",
    "pass_accuracy_pct": "Pass_Accuracy",
    "minutes_played": "Minutes_Played",
    "matches_played": "Matches_Played",
    "distance_run_km": "Distance_Run_km",
    "sprint_speed_kmh": "Sprint_Speed_kmh",
    "tackles": "Tackles",
    "interceptions": "Interceptions",
    "saves": "Saves",
    "clean_sheets": "Clean_Sheets",
    "yellow_cards": "Yellow_Cards",
    "red_cards": "Red_Cards",
    "performance_rating": "Performance_Rating",
}
TOP_PERFORMERS = 50

# Inputs of the gold mart (types after coercion) and their files;
# file names may carry any prefix.
MATCH_SCHEMA = """
    match_id STRING, match_date_utc STRING, stage STRING, group_id STRING,
    stadium STRING, city STRING, referee STRING, home_team STRING, away_team STRING,
    home_goals INT, away_goals INT, home_xg DOUBLE, away_xg DOUBLE,
    possession_home_pct DOUBLE, shots_home INT, shots_away INT,
    shots_on_target_home INT, shots_on_target_away INT,
    cards_yellow_home INT, cards_yellow_away INT, cards_red_home INT,
    cards_red_away INT, attendance INT
"""
ATTENDANCE_SCHEMA = """
    match_id STRING, match_date_utc STRING, stadium STRING, city STRING,
    capacity INT, attendance INT, occupancy_pct DOUBLE, ticket_price_avg_usd DOUBLE,
    ticket_revenue_usd DOUBLE, hospitality_revenue_usd DOUBLE,
    concession_spend_per_capita_usd DOUBLE, concession_revenue_usd DOUBLE,
    security_incidents_count INT, transport_disruption_minutes INT,
    fan_satisfaction_score DOUBLE
"""
TEAM_KPI_SCHEMA = """
    team STRING, group_id STRING, stage STRING, asof_date STRING,
    played INT, points INT, goals_for INT, goals_against INT, goal_diff INT,
    xg_for DOUBLE, xg_against DOUBLE, shots_pg DOUBLE, shots_on_target_pg DOUBLE,
    pass_accuracy_pct DOUBLE, possession_pct DOUBLE, pressing_ppda DOUBLE,
    duels_won_pct DOUBLE, set_piece_xg DOUBLE, total_distance_km DOUBLE,
    injuries_reported INT
"""
MARKETING_SCHEMA = """
    date_utc STRING, channel STRING, campaign STRING, metric STRING,
    region STRING, value DOUBLE, unit STRING
"""
PLAYER_MATCH_SCHEMA = """
    match_id STRING, match_date_utc STRING, player_name STRING, team STRING,
    position STRING, minutes INT, goals INT, assists INT, shots INT,
    shots_on_target INT, key_passes INT, passes_completed INT,
    dribbles_completed INT, tackles INT, interceptions INT, xg DOUBLE, xa DOUBLE
"""
STANDINGS_SCHEMA = "team STRING, pos INT, played INT, points INT"
SNAPSHOT_SCHEMA = """
    player_name STRING, team STRING, position STRING, goals INT, assists INT,
    goal_involvements INT, minutes_played INT
"""
# The tournament's files begin with a prefix that the job can change.
GOLD_PREFIX = "can2025_"
GOLD_FILES = {
    "matches": "{prefix}matches.csv",
    "attendance": "{prefix}match_attendance.csv",
    "team_kpis": "{prefix}team_kpis.csv",
    "marketing": "{prefix}marketing_daily.csv",
    "player_match": "{prefix}player_match_stats.csv",
    "standings": "group_standings_raw.csv",
    "snapshot": "players_detailed_stats.csv",
}
REQUIRED_GOLD_INPUTS = ["matches", "attendance", "team_kpis"]

# Measures copied from attendance and KPI rows into the wide table.
ATTENDANCE_MEASURES = [
    "capacity", "occupancy_pct", "ticket_revenue_usd", "hospitality_revenue_usd",
    "concession_revenue_usd", "fan_satisfaction_score",
]
KPI_SIDE_MEASURES = {
    "xg_for": "xg_for_group",
    "xg_against": "xg_against_group",
    "pass_accuracy_pct": "pass_accuracy_pct",
    "pressing_ppda": "pressing_ppda",
    "injuries_reported": "injuries_reported",
}
HOME_WIN, AWAY_WIN, DRAW = "HOME_WIN", "AWAY_WIN", "DRAW"

# Key and date formats.
KEY_SEPARATOR = "|"
DATE_ID_FORMAT = "yyyyMMdd"
SHORT_WEEKDAY, LONG_WEEKDAY = "E", "EEEE"

# File messages.
ENVELOPE_SCHEMA = """
    rel_path STRING, filename STRING, content_b64 STRING, content_type STRING,
    ts_ms BIGINT, type STRING
"""
CONTENT_TYPE = "application/octet-stream"
DONE_TYPE = "_DONE_"
FILES_TOPIC = "data_files"
PLAYER_TOPIC = "player-data"

# Dashboard variables (options and defaults) and panel settings.
ALL_OPTION = "All"
MAX_AGE_OPTIONS = [23, 28, 32, 99]
MIN_RATING_OPTIONS = [7.0, 7.5, 8.0, 8.5]
DEFAULT_POSITION, DEFAULT_MAX_AGE, DEFAULT_MIN_RATING = "All", 28, 8.0
TOTAL_GOALS_STEPS = [(0, "blue"), (5, "green"), (10, "red")]
TOTAL_ASSISTS_STEPS = [(0, "blue"), (2, "green"), (5, "red")]
TOTAL_PLAYERS_STEPS = [(0, "blue"), (50, "green"), (100, "red")]
AVG_RATING_STEPS = [(0, "blue"), (7.5, "green"), (9, "red")]
COUNTRY_GAUGE_PERCENT_STEPS = [(0, "green"), (70, "orange"), (85, "red")]

# Document splitting, retrieval and prompt.
CHUNK_SIZE, CHUNK_OVERLAP = 1000, 100
CHUNK_SEPARATORS = ["\n\n", "\n", " ", ""]
RETRIEVED_CHUNKS = 4
PROMPT_TEMPLATE = """Answer the question directly and briefly using only the provided context.
- Keep it simple and clear.
- Do not provide long explanations or extra notes.
- If you don't know, just say so.

Context: {context}
Question: {question}
Answer:"""

# Markup removed before text is read aloud: characters dropped,
# links unwrapped to their label, the dot after a number dropped.
SPEECH_MARKS = ["*", "#"]
SPEECH_PATTERNS = [
    (r"\[([^\]]+)\]\([^\)]+\)", "$1"),
    (r"(?<=\p{Nd})\.", ""),
]

# Table panels, shown column -> star column or measure.
RANKING_COLUMNS = {
    "Player Name": "player_name",
    "Country": "country_name",
    "Age": "age",
    "Position": "position_name",
    "Performance Rating": "performance_rating",
    "Goals": "goals",
    "Assists": "assists",
    "Total Contributions": "goal_contributions",
    "Pass %": "pass_accuracy_pct",
    "Minutes": "minutes_played",
    "Distance (km)": "distance_run_km",
    "Tackles": "tackles",
    "Interceptions": "interceptions",
    "Yellows": "yellow_cards",
    "Reds": "red_cards",
    "Updated At": "created_at",
}
COUNTRY_TABLE_SUMS = {
    "Total Goals": "goals",
    "Total Assists": "assists",
    "Total Minutes": "minutes_played",
    "Tackles": "tackles",
    "Interceptions": "interceptions",
    "Yellow Cards": "yellow_cards",
    "Red Cards": "red_cards",
}
TOP_CONTRIBUTORS, TOP_COUNTRIES, GAUGE_COUNTRIES, TABLE_ROWS = 10, 10, 5, 15
