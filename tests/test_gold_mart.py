from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline.session import shared_dir
from touchline import fixed_values as fv
from touchline.plans import gold, jobs
from touchline.sources import sinks, tables


def frame(spark, schema, *data):
    """Rows given as dicts; columns not named are null."""
    names = [f.split()[0] for f in schema.split(",")]
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in data], schema)


def match(**values):
    return {"match_id": "m1", "match_date_utc": "2025-01-03 18:00:00", "stadium": "S", "city": "C", "referee": "R",
            "home_team": "A", "away_team": "B", "home_goals": 2, "away_goals": 1, **values}


def kpi(**values):
    return {"team": "A", "group_id": "G1", "stage": "Group", "asof_date": "2025-01-01", "xg_for": 1.0, **values}


@pytest.fixture
def inputs(spark):
    return {
        "matches": frame(spark, fv.MATCH_SCHEMA, match(), match(match_id="m2", home_goals=None, referee=None, city="D"),
                         match(match_id="m3", match_date_utc="later", home_team="Z", stadium=None)),
        "attendance": frame(spark, fv.ATTENDANCE_SCHEMA,
                            {"match_id": "m1", "match_date_utc": "2025-01-03 18:00:00", "stadium": "S", "city": "C", "capacity": 10},
                            {"match_id": "m9", "match_date_utc": "2025-01-09 18:00:00", "stadium": "S", "city": "none"}),
        "team_kpis": frame(spark, fv.TEAM_KPI_SCHEMA, kpi(), kpi(asof_date="2025-01-05", xg_for=3.0), kpi(team="B")),
        "marketing": frame(spark, fv.MARKETING_SCHEMA,
                           {"date_utc": "2025-01-04", "channel": "web", "campaign": None, "metric": "m", "value": 1.0},
                           {"date_utc": "2025-01-04", "channel": "tv", "campaign": "c", "metric": "m", "value": 2.0}),
        "player_match": frame(spark, fv.PLAYER_MATCH_SCHEMA,
                              {"match_id": "m1", "match_date_utc": "2025-01-03", "player_name": "P", "team": "A", "position": "GK", "goals": 1},
                              {"match_id": "m2", "match_date_utc": "2025-01-03", "player_name": "P", "team": "A", "position": "FW", "goals": 2},
                              {"match_id": "m2", "match_date_utc": "2025-01-03", "player_name": "P", "team": "Q", "position": "DF", "goals": 3}),
        "standings": frame(spark, fv.STANDINGS_SCHEMA, {"team": "A", "pos": 1, "played": 1, "points": 3}, {"team": "Y", "pos": 2}),
        "snapshot": None,
    }


def test_required_inputs(spark, inputs):
    with pytest.raises(FileNotFoundError, match="attendance, team_kpis"):
        gold.build(spark, {**inputs, "attendance": None, "team_kpis": None})


def test_absent_optional_inputs_give_empty_typed_tables(spark, inputs):
    full = gold.build(spark, inputs)
    bare = gold.build(spark, {k: v if k in fv.REQUIRED_GOLD_INPUTS else None for k, v in inputs.items()})
    for name in ("fact_marketing", "dim_channel", "fact_player_match", "group_standings", "players_snapshot_gold"):
        assert bare[name].count() == 0
        assert bare[name].dtypes == full[name].dtypes


def test_dimensions(spark, inputs):
    out = gold.build(spark, inputs)
    assert rows(out["dim_team"].select("team_name")) == [("A",), ("B",)]
    assert rows(out["dim_stadium"].select("stadium_name", "city")) == [("S", "C"), ("S", "D"), (None, "C")]
    assert rows(out["dim_referee"].select("referee_name")) == [("R",)]
    assert rows(out["dim_player"].select("player_name", "team_name", "position")) == [("P", "A", "FW"), ("P", "Q", "DF")]
    assert rows(out["dim_campaign"].select("campaign")) == [("c",)]
    assert rows(out["dim_date"].select("date_id")) == [
        (20250101,), (20250103,), (20250104,), (20250105,), (20250109,), (None,)]


def test_fact_matches(spark, inputs):
    out = gold.build(spark, inputs)
    facts = {r["match_id"]: r for r in out["fact_matches"].collect()}
    assert len(facts) == 3 and len(out["fact_matches"].columns) == 23
    assert facts["m1"]["match_date_id"] == 20250103 and facts["m3"]["match_date_id"] is None
    assert facts["m3"]["home_team_id"] is None and facts["m3"]["away_team_id"] is not None
    assert facts["m2"]["referee_id"] is None and facts["m3"]["stadium_id"] is None
    assert out["fact_matches"].join(out["dim_stadium"], "stadium_id").count() == 2


def test_facts_keep_their_grain(spark, inputs):
    out = gold.build(spark, inputs)
    assert out["fact_attendance"].count() == 2 and len(out["fact_attendance"].columns) == 14
    assert out["fact_attendance"].where("stadium_id IS NULL").count() == 1
    assert out["fact_team_kpis"].count() == 3 and len(out["fact_team_kpis"].columns) == 21
    assert out["fact_team_kpis"].join(out["dim_team"], "team_id").count() == 3
    player = out["fact_player_match"]
    assert player.count() == 3 and len(player.columns) == 17
    assert rows(player.select("goals", "position")) == [(1, "FW"), (2, "FW"), (3, "DF")]
    assert player.where("team_id IS NULL").count() == 1
    assert rows(out["fact_marketing"].select("value", F.expr("campaign_id IS NULL"))) == [(1.0, True), (2.0, False)]


def test_wide_table(spark, inputs):
    wide = gold.build(spark, inputs)["bigtable_gold"]
    got = {r["match_id"]: r for r in wide.collect()}
    assert len(wide.columns) == 40 and wide.count() == 3
    assert [got[m]["match_result"] for m in ("m1", "m2", "m3")] == ["HOME_WIN", "DRAW", "HOME_WIN"]
    assert got["m1"]["home_xg_for_group"] == 3.0 and got["m3"]["home_xg_for_group"] is None
    assert got["m1"]["capacity"] == 10 and got["m2"]["capacity"] is None


def test_all_snapshots_repeat_the_match(spark, inputs):
    wide = gold.build(spark, inputs, all_snapshots=True)["bigtable_gold"]
    assert rows(wide.groupBy("match_id").count()) == [("m1", 2), ("m2", 2), ("m3", 1)]


def test_standings_and_snapshot(spark, inputs):
    snap = frame(spark, fv.SNAPSHOT_SCHEMA, {"player_name": "P", "team": "A", "goals": 1})
    out = gold.build(spark, {**inputs, "snapshot": snap})
    assert rows(out["group_standings"].select("team_name", "group_id", "pos")) == [("A", "G1", 1), ("Y", None, 2)]
    assert out["players_snapshot_gold"].join(out["dim_player"], "player_id").count() == 1


def test_build_loads_from_files(spark, inputs, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "mart")
    for name, df in inputs.items():
        if df is not None:
            df.write.option("header", True).csv(str(folder / fv.GOLD_FILES[name].format(prefix="cup_")))
    # a file of another name with other columns is not mixed in
    (folder / "old_matches.csv").write_text("home_team,away_team,match_id\nC,D,m9\n")
    counts = jobs.run_gold(spark, str(folder), sinks.parquet_sink(out), prefix="cup_")
    assert counts["fact_matches"] == 3 and counts["players_snapshot_gold"] == 0 and len(counts) == 15
    assert spark.read.parquet(f"{out}/_smoke_test").count() == 1
    scratch = Path(shared_dir(spark)) / "touchline"
    before = {p.name for p in scratch.iterdir()}
    jobs.run_gold(spark, str(folder), sinks.parquet_sink(out), prefix="cup_")
    assert {p.name for p in scratch.iterdir()} == before
    assert spark.read.parquet(f"{out}/players_snapshot_gold").columns[0] == "player_id"


def test_malformed_csv_values_become_null(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("match_id,match_date_utc,home_goals,extra\n007,2025-01-03,two,1\n008,bad,1.9,2\n")
    got = rows(gold.typed_matches(tables.read_csv_optional(spark, str(path), fv.MATCH_SCHEMA))
               .select("match_id", "match_date", "home_goals", "stadium").withColumn("match_date", F.col("match_date").cast("string")))
    assert got == [("007", "2025-01-03", None, None), ("008", None, 1, None)]
