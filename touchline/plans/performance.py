"""Player performance mart: cleaning, dimensions, fact, aggregates.

All keys are content hashes, so the fact computes the keys of its dimension
rows itself. Building the whole star costs one shuffle (the dedup); no
dimension is joined to make the fact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.functions.calendar import calendar_parts
from touchline.functions.cleaning import canonical, is_positive, ratio, rollup_category
from touchline.functions.keys import composite_key, name_key
from touchline.operators.dedup import first_by
from touchline.operators.topk import top_n

DEFAULTS = {
    **{c: 0 for c in fv.ZERO_INT_COLUMNS},
    **{c: 0.0 for c in fv.ZERO_DOUBLE_COLUMNS},
}


def clean_players(raw: DataFrame) -> DataFrame:
    """One normalised row per (name, country); rows without either are dropped."""
    return normalise_players(first_by(keyed_players(raw), fv.PLAYER_KEY))


def keyed_players(raw: DataFrame) -> DataFrame:
    """Rows that have a key. The filter is on the dedup key, so it runs before the shuffle."""
    return raw.where(F.col("Player_Name").isNotNull() & F.col("Country").isNotNull())


def normalise_players(rows: DataFrame) -> DataFrame:
    """Numbers filled, position canonical, activity flag; age keeps its nulls."""
    return (
        rows.fillna(DEFAULTS)
        .withColumn("Position", canonical(F.col("Position"), fv.POSITION_ALIASES))
        .withColumn("is_active", is_positive(F.col("Minutes_Played")))
    )


def _position_name() -> Column:
    return F.coalesce(F.col("Position"), F.lit(fv.UNKNOWN))


def dim_player(clean: DataFrame, run_ts: Column) -> DataFrame:
    return clean.select(
        composite_key(*fv.PLAYER_KEY).alias("player_id"),
        F.col("Player_Name").alias("player_name"),
        F.col("Age").alias("age"),
        F.col("Position").alias("position"),
        run_ts.alias("created_at"),
        run_ts.alias("updated_at"),
    )


def dim_country(clean: DataFrame, run_ts: Column) -> DataFrame:
    names = clean.select(F.col("Country").alias("country_name")).distinct()
    return names.select(
        name_key("country_name").alias("country_id"), "country_name", run_ts.alias("created_at")
    )


def dim_position(clean: DataFrame, run_ts: Column) -> DataFrame:
    """Positions in use; rows without one belong to the Unknown member."""
    names = clean.select(_position_name().alias("position_name")).distinct()
    return names.select(
        name_key("position_name").alias("position_id"),
        "position_name",
        rollup_category(F.col("position_name"), fv.POSITION_CATEGORY).alias("position_category"),
        run_ts.alias("created_at"),
    )


def dim_date(spark: SparkSession, start: str = fv.CALENDAR_START, end: str = fv.CALENDAR_END) -> DataFrame:
    """Tournament calendar, one row per day."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return calendar_between(bounds)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """Every day from ``start`` to ``end`` of the given row."""
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("_day"))
    return days.select(*[c.alias(n) for n, c in calendar_parts(F.col("_day")).items()])


def _fact_columns(run_ts: Column, date_id: int) -> list[Column | str]:
    matches = F.col("Matches_Played")
    return [
        composite_key(*fv.PLAYER_KEY, F.lit(date_id)).alias("performance_id"),
        composite_key(*fv.PLAYER_KEY).alias("player_id"),
        name_key("Country").alias("country_id"),
        name_key(_position_name()).alias("position_id"),
        F.lit(date_id).alias("date_id"),
        *[F.col(source).alias(name) for name, source in fv.PERFORMANCE_MEASURES.items()],
        (F.col("Goals") + F.col("Assists")).alias("goal_contributions"),
        ratio(F.col("Minutes_Played"), matches).alias("avg_minutes_per_match"),
        ratio(F.col("Goals"), matches).alias("goals_per_match"),
        F.col("is_active"),
        run_ts.alias("created_at"),
    ]


def fact_performance(clean: DataFrame, run_ts: Column, date_id: int = fv.PERFORMANCE_DATE_ID) -> DataFrame:
    return clean.select(*_fact_columns(run_ts, date_id))


def star_view(fact: DataFrame, players: DataFrame, countries: DataFrame, positions: DataFrame) -> DataFrame:
    """Fact with its dimension attributes, from stored star tables."""
    return (
        fact.join(players.select("player_id", "player_name", "age"), "player_id")
        .join(positions.select("position_id", "position_name"), "position_id")
        .join(countries.select("country_id", "country_name"), "country_id")
    )


def stored_view(read: Callable[[str], DataFrame]) -> DataFrame:
    """The panel view over loaded tables; ``read`` returns a table by name."""
    return star_view(
        read("fact_performance"), read("dim_player"), read("dim_country"), read("dim_position")
    )


def clean_view(clean: DataFrame, run_ts: Column, date_id: int = fv.PERFORMANCE_DATE_ID) -> DataFrame:
    """The same rows as ``star_view`` taken from the clean frame without a join."""
    return clean.select(
        *_fact_columns(run_ts, date_id),
        F.col("Player_Name").alias("player_name"),
        F.col("Age").alias("age"),
        _position_name().alias("position_name"),
        F.col("Country").alias("country_name"),
    )


def agg_country(fact: DataFrame, countries: DataFrame, run_ts: Column) -> DataFrame:
    """Totals per country over all players, active or not.

    The fact is reduced to one row per country before the names are joined.
    """
    totals = fact.groupBy("country_id").agg(
        F.count("player_id").alias("total_players"),
        F.sum("goals").alias("total_goals"),
        F.sum("assists").alias("total_assists"),
        F.avg("performance_rating").alias("avg_rating"),
        F.sum("minutes_played").alias("total_minutes"),
        F.sum("yellow_cards").alias("total_yellow_cards"),
        F.sum("red_cards").alias("total_red_cards"),
        F.avg("pass_accuracy_pct").alias("avg_pass_accuracy"),
    )
    return totals.join(countries.select("country_id", "country_name"), "country_id").withColumn(
        "created_at", run_ts
    )


def agg_position(fact: DataFrame, positions: DataFrame, run_ts: Column) -> DataFrame:
    totals = fact.groupBy("position_id").agg(
        F.count("player_id").alias("total_players"),
        F.avg("performance_rating").alias("avg_rating"),
        F.avg("goals").alias("avg_goals"),
        F.avg("assists").alias("avg_assists"),
        F.avg("sprint_speed_kmh").alias("avg_sprint_speed"),
        F.avg("distance_run_km").alias("avg_distance_run"),
        F.max("performance_rating").alias("max_rating"),
    )
    return totals.join(positions.select("position_id", "position_name"), "position_id").withColumn(
        "created_at", run_ts
    )


def top_performers(
    fact: DataFrame, players: DataFrame, countries: DataFrame, run_ts: Column, n: int = fv.TOP_PERFORMERS
) -> DataFrame:
    """The ``n`` best-rated rows, equal ratings in key order.

    Every fact row has its dimension rows, so the names are joined after the
    limit, to ``n`` rows.
    """
    order = [F.desc_nulls_last("performance_rating"), F.asc("performance_id")]
    best = top_n(fact, order, n, rank="rank")
    return (
        best.join(players.select("player_id", "player_name"), "player_id")
        .join(countries.select("country_id", "country_name"), "country_id")
        .select(
            "rank", "player_name", "country_name", "performance_rating", "goals", "assists",
            "goal_contributions", run_ts.alias("created_at"),
        )
    )
