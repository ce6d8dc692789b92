"""Dashboard panels over the performance star.

Every panel takes the star as one view (``star_view`` or ``clean_view``) and the
dashboard variables. Variables are bound as literals, never spliced into text.
Each ranking has a total order, so a panel shows the same rows on every refresh.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.operators.bands import band, percent_of_range
from touchline.operators.topk import keep_top_groups, top_n


@dataclass(frozen=True)
class Variables:
    position: str = fv.DEFAULT_POSITION
    max_age: int = fv.DEFAULT_MAX_AGE
    min_rating: float = fv.DEFAULT_MIN_RATING


DEFAULTS = Variables()


def shown(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    """Rows that pass the dashboard filters; players without minutes never show."""
    rows = view.where(
        (F.col("age") <= F.lit(v.max_age))
        & (F.col("performance_rating") >= F.lit(v.min_rating))
        & (F.col("minutes_played") > 0)
    )
    if v.position != fv.ALL_OPTION:
        rows = rows.where(F.col("position_name") == F.lit(v.position))
    return rows


def _series(metric: Column, value: Column) -> list[Column]:
    return [F.lit(0).alias("time"), metric.alias("metric"), value.alias("value")]


def _stat(rows: DataFrame, title: str, value: Column) -> DataFrame:
    return rows.agg(value.alias("_value")).select(*_series(F.lit(title), F.col("_value")))


def total_goals(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    return _stat(shown(view, v), "Total Goals", F.sum("goals"))


def total_assists(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    return _stat(shown(view, v), "Total Assists", F.sum("assists"))


def total_players(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    return _stat(shown(view, v), "Total Players", F.count_distinct("player_id"))


def avg_rating(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    return _stat(shown(view, v), "Avg Performance Rating", F.avg("performance_rating"))


def headline_stats(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    """The four single-value panels with their bands, in one pass over the star."""
    stats = [
        ("Total Goals", F.sum("goals"), fv.TOTAL_GOALS_STEPS),
        ("Total Assists", F.sum("assists"), fv.TOTAL_ASSISTS_STEPS),
        ("Total Players", F.count_distinct("player_id"), fv.TOTAL_PLAYERS_STEPS),
        ("Avg Performance Rating", F.avg("performance_rating"), fv.AVG_RATING_STEPS),
    ]
    totals = shown(view, v).agg(*[value.cast("double").alias(title) for title, value, _ in stats])
    rows = [
        F.struct(
            *_series(F.lit(title), F.col(title)),
            band(F.col(title), steps).alias("band"),
        )
        for title, _, steps in stats
    ]
    return totals.select(F.inline(F.array(*rows)))


def _grouped(view: DataFrame, v: Variables, key: str, value: Column) -> DataFrame:
    rows = shown(view, v).groupBy(key).agg(value.alias("_value"))
    return rows.select(*_series(F.col(key), F.col("_value")))


def _ranked() -> list[Column]:
    return [F.desc_nulls_last("value"), F.asc("metric")]


def rating_by_position(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    return _grouped(view, v, "position_name", F.avg("performance_rating")).orderBy(*_ranked())


def position_count(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    return _grouped(view, v, "position_name", F.count(F.lit(1))).orderBy(*_ranked())


def position_share(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    """Count per position and its percentage of all shown rows.

    The window runs over one row per position, after the aggregation.
    """
    counts = _grouped(view, v, "position_name", F.count(F.lit(1)))
    total = F.sum("value").over(Window.partitionBy())
    return counts.withColumn("percent", F.col("value") * 100.0 / total).orderBy(*_ranked())


def top_contributors(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    order = [F.desc_nulls_last("goal_contributions"), F.asc("player_name"), F.asc("performance_id")]
    rows = shown(view, v).select("player_name", "performance_id", "goal_contributions")
    return top_n(rows, order, fv.TOP_CONTRIBUTORS).select(
        *_series(F.col("player_name"), F.col("goal_contributions"))
    )


def country_count(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    return top_n(_grouped(view, v, "country_name", F.count(F.lit(1))), _ranked(), fv.TOP_COUNTRIES)


def top_countries(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    """Shown players of the countries that have most players overall.

    The five countries are chosen without the dashboard filters.
    """
    ranking = view.groupBy("country_name").agg(F.count_distinct("player_id").alias("_players"))
    order = [F.desc("_players"), F.asc("country_name")]
    rows = keep_top_groups(shown(view, v), "country_name", ranking, order, fv.GAUGE_COUNTRIES)
    counts = rows.groupBy("country_name").agg(F.count_distinct("player_id").alias("_value"))
    return counts.select(*_series(F.col("country_name"), F.col("_value"))).orderBy(*_ranked())


def ranking(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    order = [F.desc_nulls_last("performance_rating"), F.asc("performance_id")]
    best = top_n(shown(view, v), order, fv.TABLE_ROWS, rank="Rank")
    return best.select("Rank", *[F.col(c).alias(title) for title, c in fv.RANKING_COLUMNS.items()])


def country_table(view: DataFrame, v: Variables = DEFAULTS) -> DataFrame:
    sums = {title: F.sum(c).alias(title) for title, c in fv.COUNTRY_TABLE_SUMS.items()}
    table = shown(view, v).groupBy(F.col("country_name").alias("Country")).agg(
        F.count_distinct("player_id").alias("Total Players"),
        F.avg("performance_rating").alias("Avg Rating"),
        sums["Total Goals"],
        sums["Total Assists"],
        F.avg("pass_accuracy_pct").alias("Avg Pass Accuracy %"),
        *[c for title, c in sums.items() if title not in ("Total Goals", "Total Assists")],
        F.max("created_at").alias("Updated At"),
    )
    return top_n(table, [F.desc_nulls_last("Avg Rating"), F.asc("Country")], fv.TABLE_ROWS)


def with_percent_band(panel: DataFrame, steps=tuple(fv.COUNTRY_GAUGE_PERCENT_STEPS)) -> DataFrame:
    """Band of each value within the range of the shown values.

    A panel is already reduced to one row per shown group.
    """
    everything = Window.partitionBy()
    percent = percent_of_range(
        F.col("value"), F.min("value").over(everything), F.max("value").over(everything)
    )
    return panel.withColumn("percent", percent).withColumn("band", band(F.col("percent"), steps))


def position_options(positions: DataFrame) -> DataFrame:
    """Choices of the position variable: every position and the catch-all."""
    names = positions.select(F.col("position_name").alias("__text"))
    every = positions.sparkSession.range(1).select(F.lit(fv.ALL_OPTION).alias("__text"))
    return names.unionByName(every).withColumn("__value", F.col("__text")).orderBy("__text")


def option_grid(view: DataFrame) -> DataFrame:
    """Goals and assists shown for each choice of maximum age and minimum rating.

    Rows are first summed into the cell of the tightest choices they pass; only
    those few cells are spread over the looser choices.
    """
    ages = F.array(*[F.lit(a) for a in fv.MAX_AGE_OPTIONS])
    ratings = F.array(*[F.lit(r) for r in fv.MIN_RATING_OPTIONS])
    cells = (
        view.where(F.col("minutes_played") > 0)
        .select(
            F.array_min(F.filter(ages, lambda a: a >= F.col("age"))).alias("_age"),
            F.array_max(F.filter(ratings, lambda r: r <= F.col("performance_rating"))).alias("_rating"),
            "goals", "assists",
        )
        .where(F.col("_age").isNotNull() & F.col("_rating").isNotNull())
        .groupBy("_age", "_rating")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("goals").alias("g"), F.sum("assists").alias("a"))
    )
    return (
        cells.withColumn("max_age", F.explode(F.filter(ages, lambda a: a >= F.col("_age"))))
        .withColumn("min_rating", F.explode(F.filter(ratings, lambda r: r <= F.col("_rating"))))
        .groupBy("max_age", "min_rating")
        .agg(
            F.sum("n").alias("total_rows"),
            F.sum("g").alias("total_goals"),
            F.sum("a").alias("total_assists"),
        )
    )


PANELS = {
    "total_goals": total_goals,
    "total_assists": total_assists,
    "total_players": total_players,
    "avg_rating": avg_rating,
    "rating_by_position": rating_by_position,
    "top_contributors": top_contributors,
    "country_count": country_count,
    "position_share": position_share,
    "top_countries": top_countries,
    "position_count": position_count,
    "ranking": ranking,
    "country_table": country_table,
}
