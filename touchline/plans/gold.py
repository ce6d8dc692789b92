"""Gold mart: teams, stadiums, referees, players, marketing, matches, wide table.

Dimensions built from the table that a fact is built from need no join: the
fact computes the same content key. Joins remain where a key must be looked up
in another table, such as teams, which come from the KPI file.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.functions.calendar import date_id, fact_date_parts, parse_timestamp
from touchline.functions.cleaning import coerce, outcome
from touchline.functions.keys import composite_key, name_key
from touchline.operators.asof import asof_join
from touchline.operators.dedup import first_by, latest_by
from touchline.operators.lookup import lookup
from touchline.schemas import measures
from touchline.sources.tables import empty, require, stored


# --- typed inputs -----------------------------------------------------------

def typed_matches(raw: DataFrame) -> DataFrame:
    return _with_match_time(coerce(raw, fv.MATCH_SCHEMA))


def typed_attendance(raw: DataFrame) -> DataFrame:
    return _with_match_time(coerce(raw, fv.ATTENDANCE_SCHEMA))


def typed_player_match(raw: DataFrame) -> DataFrame:
    return _with_match_time(coerce(raw, fv.PLAYER_MATCH_SCHEMA))


def typed_team_kpis(raw: DataFrame) -> DataFrame:
    return coerce(raw, fv.TEAM_KPI_SCHEMA).withColumn("asof_date", _soft_date("asof_date"))


def typed_marketing(raw: DataFrame) -> DataFrame:
    return coerce(raw, fv.MARKETING_SCHEMA).withColumn("date", _soft_date("date_utc"))


def _with_match_time(df: DataFrame) -> DataFrame:
    return df.withColumn("match_ts", parse_timestamp(F.col("match_date_utc"))).withColumn(
        "match_date", F.to_date("match_ts")
    )


def _soft_date(column: str) -> Column:
    return F.to_date(parse_timestamp(F.col(column)))


# --- dimensions -------------------------------------------------------------

def dim_team(kpis: DataFrame) -> DataFrame:
    teams = kpis.select(F.col("team").alias("team_name"), "group_id")
    return first_by(teams, ["team_name"]).withColumn("team_id", name_key("team_name"))


def dim_stadium(matches: DataFrame) -> DataFrame:
    places = matches.select(F.col("stadium").alias("stadium_name"), "city").distinct()
    return places.withColumn("stadium_id", composite_key("stadium_name", "city"))


def dim_referee(matches: DataFrame) -> DataFrame:
    return _named(matches, "referee", "referee_name", "referee_id")


def dim_player(player_match: DataFrame) -> DataFrame:
    """One row per (player, team); of several positions the first by name is kept."""
    rows = player_match.select("player_name", F.col("team").alias("team_name"), "position")
    return first_by(rows, ["player_name", "team_name"]).withColumn(
        "player_id", composite_key("player_name", "team_name")
    )


def dim_campaign(marketing: DataFrame) -> DataFrame:
    return _named(marketing, "campaign", "campaign", "campaign_id")


def dim_channel(marketing: DataFrame) -> DataFrame:
    return _named(marketing, "channel", "channel", "channel_id")


def _named(df: DataFrame, source: str, name: str, key: str) -> DataFrame:
    names = df.where(F.col(source).isNotNull()).select(F.col(source).cast("string").alias(name))
    return names.distinct().withColumn(key, name_key(name))


def dim_date(df: DataFrame, column: str) -> DataFrame:
    """Dates that occur in a table."""
    days = df.select(F.col(column).alias("_day")).distinct()
    return days.select(*[c.alias(n) for n, c in fact_date_parts(F.col("_day")).items()])


def dim_date_all(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Dates of all facts in one dimension, so that no fact date is an orphan."""
    days = None
    for df, column in tables.values():
        part = df.select(F.col(column).alias("date")).distinct()
        days = part if days is None else days.unionByName(part)
    return dim_date(days, "date")


# --- facts ------------------------------------------------------------------

def _team_role(teams: DataFrame, role: str) -> DataFrame:
    return teams.select(
        F.col("team_name").alias(f"{role}_team"), F.col("team_id").alias(f"{role}_team_id")
    )


def _stadium_key() -> Column:
    known = F.col("stadium").isNotNull() & F.col("city").isNotNull()
    return F.when(known, composite_key("stadium", "city"))


def fact_matches(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Match facts; home and away team are two roles of one dimension."""
    known = lookup(matches, _team_role(teams, "home"), ["home_team"], ["match_id"])
    return (
        lookup(known, _team_role(teams, "away"), ["away_team"], ["match_id"])
        .select(
            "match_id",
            date_id(F.col("match_date")).alias("match_date_id"),
            "match_ts", "stage", "group_id",
            _stadium_key().alias("stadium_id"),
            name_key("referee").alias("referee_id"),
            "home_team_id", "away_team_id",
            *measures(fv.MATCH_SCHEMA),
        )
    )


def fact_attendance(attendance: DataFrame, stadiums: DataFrame) -> DataFrame:
    place = stadiums.select(F.col("stadium_name").alias("stadium"), "city", "stadium_id")
    return lookup(attendance, place, ["stadium", "city"], ["match_id"]).select(
        "match_id", date_id(F.col("match_date")).alias("match_date_id"), "stadium_id",
        *measures(fv.ATTENDANCE_SCHEMA),
    )


def fact_team_kpis(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        date_id(F.col("asof_date")).alias("asof_date_id"), "asof_date",
        name_key("team").alias("team_id"), "group_id", "stage",
        *measures(fv.TEAM_KPI_SCHEMA),
    )


def fact_marketing(marketing: DataFrame) -> DataFrame:
    return marketing.select(
        date_id(F.col("date")).alias("date_id"), "date",
        name_key("channel").alias("channel_id"), name_key("campaign").alias("campaign_id"),
        "metric", "region", "value", "unit",
    )


def fact_player_match(player_match: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Player facts. Players are matched by name and team, so each row stays one row."""
    numbers = measures(fv.PLAYER_MATCH_SCHEMA)
    rows = player_match.select(
        "match_id", "match_date", "player_name", F.col("team").alias("team_name"), *numbers
    )
    known = lookup(rows, players, ["player_name", "team_name"], ["match_id"], salts=1)
    return (
        lookup(known, teams.select("team_name", "team_id"), ["team_name"], ["match_id"])
        .select(
            "match_id", date_id(F.col("match_date")).alias("match_date_id"), "team_id",
            "player_id", "position", *numbers,
        )
    )


# --- wide and optional tables -----------------------------------------------

def latest_kpis(kpis: DataFrame) -> DataFrame:
    """Most recent snapshot of each team, with the measures the wide table shows."""
    snapshots = kpis.select("team", "asof_date", "stage", *fv.KPI_SIDE_MEASURES)
    return latest_by(snapshots, ["team"], ["asof_date", "stage"])


def _kpi_role(kpis: DataFrame, role: str, more: tuple[str, ...] = ()) -> DataFrame:
    return kpis.select(
        F.col("team").alias(f"{role}_team"), *more,
        *[F.col(c).alias(f"{role}_{name}") for c, name in fv.KPI_SIDE_MEASURES.items()],
    )


def bigtable(matches: DataFrame, attendance: DataFrame, sides: DataFrame) -> DataFrame:
    """One wide row per match: score, attendance, both teams' KPIs, result.

    ``sides`` has the KPIs of a team: from ``latest_kpis`` one row each; with every
    snapshot a match repeats for each pair of team snapshots.
    """
    rows = _with_attendance(matches, attendance)
    rows = lookup(rows, _kpi_role(sides, "home"), ["home_team"], ["match_id"])
    return _wide(lookup(rows, _kpi_role(sides, "away"), ["away_team"], ["match_id"]))


def bigtable_asof(matches: DataFrame, attendance: DataFrame, kpis: DataFrame, made: list[str] | None = None) -> DataFrame:
    """The wide row of each match with both teams' KPIs as they stood on its day: no snapshot from after the match."""
    rows = _with_attendance(matches, attendance)
    kpis = stored(kpis.select("team", "asof_date", "stage", *fv.KPI_SIDE_MEASURES), "kpi_snapshots", made)
    for role in ("home", "away"):
        snapshots = _kpi_role(kpis.withColumns({"_asof": F.col("asof_date"), "_stage": F.col("stage")}), role, ("_asof", "_stage"))
        rows = asof_join(rows, snapshots, [f"{role}_team"], "match_date", "_asof", ["_stage"], made=made).drop("_asof", "_stage")
    return _wide(rows)


def _with_attendance(matches: DataFrame, attendance: DataFrame) -> DataFrame:
    return matches.join(attendance.select("match_id", *fv.ATTENDANCE_MEASURES), "match_id", "left")


def _wide(rows: DataFrame) -> DataFrame:
    return rows.select(
        "match_id", "match_ts", "match_date", "stage", "group_id", "stadium", "city", "home_team", "away_team",
        *measures(fv.MATCH_SCHEMA), *fv.ATTENDANCE_MEASURES,
        *(f"{role}_{name}" for role in ("home", "away") for name in fv.KPI_SIDE_MEASURES.values()),
        outcome(F.col("home_goals"), F.col("away_goals")).alias("match_result"),
    )


def group_standings(raw: DataFrame, teams: DataFrame) -> DataFrame:
    rows = coerce(raw, fv.STANDINGS_SCHEMA).withColumnRenamed("team", "team_name")
    return rows.join(teams, "team_name", "left").select(
        "team_id", "team_name", "group_id", "pos", "played", "points"
    )


def players_snapshot(raw: DataFrame, teams: DataFrame) -> DataFrame:
    rows = coerce(raw, fv.SNAPSHOT_SCHEMA).withColumnRenamed("team", "team_name")
    return lookup(rows, teams.select("team_name", "team_id"), ["team_name"], ["player_name"]).select(
        composite_key("player_name", "team_name").alias("player_id"),
        "player_name", "team_id", "team_name", "position",
        "goals", "assists", "goal_involvements", "minutes_played",
    )


def build(
    spark: SparkSession, inputs: Mapping[str, DataFrame | None], all_snapshots: bool = False,
    made: list[str] | None = None, asof: bool = False,
) -> dict[str, DataFrame]:
    """Every gold table from raw inputs; absent optional inputs give empty tables.

    The wide table shows each team's latest KPI snapshot, with ``asof`` the latest one at the day of the match,
    with ``all_snapshots`` every one.

    ``made`` gets the scratch folders that the tables are read from.
    """
    require(inputs)
    schemas = {
        "marketing": fv.MARKETING_SCHEMA, "player_match": fv.PLAYER_MATCH_SCHEMA,
        "standings": fv.STANDINGS_SCHEMA, "snapshot": fv.SNAPSHOT_SCHEMA,
    }
    raw = {
        name: inputs.get(name) if inputs.get(name) is not None else empty(spark, schema)
        for name, schema in schemas.items()
    }
    matches = typed_matches(inputs["matches"])
    attendance = typed_attendance(inputs["attendance"])
    kpis = typed_team_kpis(inputs["team_kpis"])
    marketing = typed_marketing(raw["marketing"])
    player_match = typed_player_match(raw["player_match"])
    # Stored because several joins use them: with sizes known beforehand, small
    # sides are broadcast and the facts are not shuffled.
    teams = stored(dim_team(kpis), "dim_team", made)
    stadiums = stored(dim_stadium(matches), "dim_stadium", made)
    wide = (
        bigtable_asof(matches, attendance, kpis, made) if asof
        else bigtable(matches, attendance, kpis if all_snapshots else stored(latest_kpis(kpis), "latest_kpis", made))
    )
    players = dim_player(player_match)
    return {
        "dim_team": teams,
        "dim_stadium": stadiums,
        "dim_referee": dim_referee(matches),
        "dim_player": players,
        "dim_campaign": dim_campaign(marketing),
        "dim_channel": dim_channel(marketing),
        "dim_date": dim_date_all({
            "matches": (matches, "match_date"),
            "attendance": (attendance, "match_date"),
            "kpis": (kpis, "asof_date"),
            "marketing": (marketing, "date"),
            "player_match": (player_match, "match_date"),
        }),
        "fact_matches": fact_matches(matches, teams),
        "fact_attendance": fact_attendance(attendance, stadiums),
        "fact_team_kpis": fact_team_kpis(kpis),
        "fact_marketing": fact_marketing(marketing),
        "fact_player_match": fact_player_match(player_match, players, teams),
        "bigtable_gold": wide,
        "group_standings": group_standings(raw["standings"], teams),
        "players_snapshot_gold": players_snapshot(raw["snapshot"], teams),
    }
