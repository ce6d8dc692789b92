import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.plans import jobs, panels, performance
from touchline.sources import sinks, tables

NAMES = [f.split()[0] for f in fv.PLAYER_SCHEMA.split(",")]
BASE = dict(zip(NAMES, ["A", "X", 25, "Forward", 1, 1, 90, 1, 80.0, 10.0, 30.0, 1, 1, 0, 0, 0, 0, 8.5]))


def raw(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}[n] for n in NAMES) for c in changes], fv.PLAYER_SCHEMA)


def ts():
    return F.lit("2025-01-18 00:00:00").cast("timestamp")


def star(spark, *changes):
    clean = performance.clean_players(raw(spark, *changes))
    return (
        clean, performance.fact_performance(clean, ts()), performance.dim_player(clean, ts()),
        performance.dim_country(clean, ts()), performance.dim_position(clean, ts()),
    )


def test_cleaning_rules(spark):
    clean = performance.clean_players(raw(
        spark,
        {"Goals": 5}, {"Goals": 2}, {"Goals": 2, "Assists": None},
        {"Player_Name": None}, {"Country": None},
        {"Player_Name": "B ", "Age": None, "Position": "GK", "Minutes_Played": None, "Performance_Rating": None},
    ))
    got = {r["Player_Name"]: r for r in clean.collect()}
    assert set(got) == {"A", "B "}
    assert (got["A"]["Goals"], got["A"]["Assists"], got["A"]["is_active"]) == (2, 0, True)
    assert got["B "]["Age"] is None and got["B "]["Position"] == "Goalkeeper"
    assert got["B "]["Minutes_Played"] == 0 and got["B "]["is_active"] is False
    assert got["B "]["Performance_Rating"] == 0.0


def test_survivor_does_not_depend_on_partitioning(spark):
    df = raw(spark, *[{"Goals": g, "Assists": a} for g in range(4) for a in (None, 1, 2)])
    assert len({tuple(performance.clean_players(df.repartition(n)).first()) for n in (1, 2, 5)}) == 1


def test_same_name_and_age_in_two_countries_stays_two_rows(spark):
    _, fact, players, *_ = star(spark, {"Country": "X", "Goals": 1}, {"Country": "Y", "Goals": 1, "Assists": 0})
    assert fact.count() == players.select("player_id").distinct().count() == 2
    assert fact.agg(F.sum("goal_contributions")).first()[0] == 3


def test_null_age_and_position_survive_the_fact(spark):
    clean, fact, players, countries, positions = star(spark, {"Age": None, "Position": None, "Matches_Played": 0})
    assert fact.count() == 1
    assert rows(positions.select("position_name", "position_category")) == [("Unknown", "Unknown")]
    assert fact.join(positions, "position_id").count() == 1
    assert fact.first()["avg_minutes_per_match"] == 0.0


def test_no_orphan_and_unique_keys(spark):
    changes = [{"Player_Name": f"P{i}", "Country": f"C{i % 3}", "Position": [None, "FW", "Winger"][i % 3]} for i in range(20)]
    clean, fact, players, countries, positions = star(spark, *changes)
    for dim, key in ((players, "player_id"), (countries, "country_id"), (positions, "position_id")):
        assert dim.count() == dim.select(key).distinct().count()
        assert fact.join(dim, key, "left_anti").count() == 0
    assert clean.count() == fact.count() == 20


def test_views_agree_and_the_clean_view_has_no_join(spark):
    changes = [{"Player_Name": f"P{i}", "Country": f"C{i % 3}", "Age": [None, 20][i % 2]} for i in range(9)]
    clean, fact, players, countries, positions = star(spark, *changes)
    joined = performance.star_view(fact, players, countries, positions)
    direct = performance.clean_view(clean, ts())
    assert rows(joined.select(*sorted(joined.columns))) == rows(direct.select(*sorted(joined.columns)))
    assert "Join" not in direct._jdf.queryExecution().executedPlan().toString()


def test_stored_clean_frame_gives_the_fact_without_a_shuffle(spark):
    clean = tables.stored(performance.clean_players(raw(spark, {})), "clean")
    plan = performance.fact_performance(clean, ts())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_top_performers_break_ties_by_key(spark):
    changes = [{"Player_Name": f"P{i:02d}"} for i in range(60)] + [{"Player_Name": "Best", "Performance_Rating": 9.9}]
    clean, fact, players, countries, _ = star(spark, *changes)
    runs = [rows(performance.top_performers(fact.repartition(n), players, countries, ts())) for n in (1, 4)]
    assert runs[0] == runs[1] and len(runs[0]) == 50
    assert min(runs[0])[:2] == (1, "Best")
    assert sorted(r[0] for r in runs[0]) == list(range(1, 51))


def test_aggregates_count_inactive_players(spark):
    clean, fact, _, countries, positions = star(spark, {}, {"Player_Name": "B", "Minutes_Played": 0, "Performance_Rating": 7.5})
    row = performance.agg_country(fact, countries, ts()).first()
    assert (row["total_players"], row["total_goals"], row["avg_rating"]) == (2, 2, 8.0)
    assert performance.agg_position(fact, positions, ts()).first()["max_rating"] == 8.5


def test_calendar(spark):
    days = performance.dim_date(spark)
    assert days.count() == 29
    first, last = days.orderBy("date_id").first(), days.orderBy(F.desc("date_id")).first()
    assert (first["date_id"], first["day_of_week"], first["is_weekend"], first["week_of_year"]) == (20241221, "Saturday", True, 51)
    assert last["date_id"] == 20250118


def test_panel_filters(spark):
    view = performance.clean_view(performance.clean_players(raw(
        spark, {}, {"Player_Name": "old", "Age": 29}, {"Player_Name": "low", "Performance_Rating": 7.9},
        {"Player_Name": "idle", "Minutes_Played": 0}, {"Player_Name": "unknown age", "Age": None},
        {"Player_Name": "edge", "Age": 28, "Performance_Rating": 8.0, "Position": "GK"},
    )), ts())
    assert rows(panels.shown(view).select("player_name")) == [("A",), ("edge",)]
    assert panels.total_players(view, panels.Variables("Goalkeeper")).first()["value"] == 1
    assert panels.total_goals(view, panels.Variables("x' OR 'a'='a")).first()["value"] is None
    assert panels.total_players(view, panels.Variables(max_age=99, min_rating=7.0)).first()["value"] == 4


def test_top_countries_are_chosen_without_filters(spark):
    changes = [{"Player_Name": f"{c}{i}", "Country": c, "Performance_Rating": 8.5 if i == 0 else 1.0}
               for n, c in enumerate("ABCDEF") for i in range(n + 1)]
    view = performance.clean_view(performance.clean_players(raw(spark, *changes)), ts())
    assert rows(panels.top_countries(view).select("metric", "value")) == [(c, 1) for c in "BCDEF"]


def test_share_sums_to_hundred(spark):
    view = performance.clean_view(performance.clean_players(raw(spark, {}, {"Player_Name": "B"}, {"Player_Name": "C", "Position": "GK"})), ts())
    assert panels.position_share(view).agg(F.round(F.sum("percent"), 9)).first()[0] == 100.0


def test_headline_stats_equal_the_panels(spark):
    view = performance.clean_view(performance.clean_players(raw(spark, {"Goals": 7}, {"Player_Name": "B", "Performance_Rating": 9.5})), ts())
    got = {r["metric"]: (r["value"], r["band"]) for r in panels.headline_stats(view).collect()}
    for panel in (panels.total_goals, panels.total_assists, panels.total_players, panels.avg_rating):
        row = panel(view).first()
        assert got[row["metric"]][0] == row["value"]
    assert got["Total Goals"][1] == "green" and got["Avg Performance Rating"][1] == "red"


def test_option_grid_equals_panels(spark):
    changes = [{"Player_Name": f"P{i}", "Age": 20 + i % 15, "Performance_Rating": 7.0 + i % 20 / 10, "Goals": i} for i in range(60)]
    view = performance.clean_view(performance.clean_players(raw(spark, *changes)), ts())
    grid = {(r["max_age"], r["min_rating"]): r["total_goals"] for r in panels.option_grid(view).collect()}
    assert len(grid) == 16
    for (age, rating), goals in grid.items():
        assert panels.total_goals(view, panels.Variables("All", age, rating)).first()["value"] == goals


def test_job_writes_all_tables_and_counts(spark, tmp_path):
    source = str(tmp_path / "players")
    raw(spark, {}, {"Player_Name": "B", "Country": "Y"}, {"Player_Name": "A", "Goals": 9}).write.option("header", True).csv(source)
    out = str(tmp_path / "mart")
    counts = jobs.run_performance(spark, source, sinks.parquet_sink(out, {"fact_performance": ["date_id"]}))
    assert counts == {
        "dim_player": 2, "dim_country": 2, "dim_position": 1, "dim_date": 29, "fact_performance": 2,
        "agg_country_performance": 2, "agg_position_performance": 1, "agg_top_performers": 2,
    }
    fact, players = spark.read.parquet(f"{out}/fact_performance"), spark.read.parquet(f"{out}/dim_player")
    assert fact.join(players, "player_id").count() == 2
    assert (tmp_path / "mart" / "fact_performance" / f"date_id={fv.PERFORMANCE_DATE_ID}").exists()
    assert players.select("created_at").distinct().count() == 1


@pytest.mark.parametrize("text, want", [("25", 25), ("n/a", None)])
def test_csv_with_declared_schema(spark, tmp_path, text, want):
    path = tmp_path / "p.csv"
    path.write_text(",".join(NAMES) + "\n" + f"A ,X,{text},FW" + ",1" * 14 + "\n")
    row = tables.read_csv(spark, str(path), fv.PLAYER_SCHEMA).first()
    assert (row["Player_Name"], row["Age"], row["Performance_Rating"]) == ("A ", want, 1.0)


def test_panels_over_loaded_tables(spark, tmp_path):
    source, out = str(tmp_path / "players"), str(tmp_path / "mart")
    changes = [{"Player_Name": f"P{i}", "Country": f"C{i % 4}", "Age": 20 + i, "Goals": i} for i in range(12)]
    raw(spark, *changes).write.option("header", True).csv(source)
    jobs.run_performance(spark, source, sinks.parquet_sink(out), ts())
    direct = performance.clean_view(performance.clean_players(raw(spark, *changes)), ts())
    for name, panel in panels.PANELS.items():
        for v in (panels.DEFAULTS, panels.Variables("Forward", 24, 7.0)):
            assert rows(jobs.run_panel(spark, name, out, v)) == rows(panel(direct, v))


def test_panel_filters_reach_the_scan(spark, tmp_path, capsys):
    source, out = str(tmp_path / "players"), str(tmp_path / "mart")
    raw(spark, {}).write.option("header", True).csv(source)
    jobs.run_performance(spark, source, sinks.parquet_sink(out))
    jobs.run_panel(spark, "total_goals", out).explain("formatted")
    plan = capsys.readouterr().out
    assert "LessThanOrEqual(age,28)" in plan
    assert "GreaterThanOrEqual(performance_rating,8.0)" in plan and "GreaterThan(minutes_played,0)" in plan
    assert "player_name" not in plan


def test_bucketed_star_joins_without_a_shuffle(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart")
    _, fact, players, *_ = star(spark, *[{"Player_Name": f"P{i}"} for i in range(50)])
    same = (4, "player_id")
    sink = sinks.catalog_sink("mart", {"fact": same, "player": same}, str(tmp_path))
    assert sinks.load_tables({"fact": fact, "player": players}, sink) == {"fact": 50, "player": 50}
    joined = spark.table("mart.fact").hint("merge").join(spark.table("mart.player").hint("merge"), "player_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50
