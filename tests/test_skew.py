"""One key holds a third of all rows."""

from contextlib import contextmanager

import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.functions.cleaning import coerce
from touchline.operators import retrieval
from touchline.operators.lookup import lookup
from touchline.plans import gold
from touchline.streaming import feeds


@contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in (key.replace("__", ".") for key in conf)}
    try:
        for key, value in conf.items():
            spark.conf.set(key.replace("__", "."), value)
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def matches(spark):
    raw = spark.range(0, 120_000, 1, 6).selectExpr(
        "id AS match_id", "'2025-01-03' AS match_date_utc",
        "if(id % 3 = 0, 'hot', concat('team', id % 997)) AS home_team",
        "if(id % 3 = 1, NULL, concat('team', id % 991)) AS away_team",
        "sha2(CAST(id AS STRING), 512) AS stage",
    )
    return gold._with_match_time(coerce(raw, fv.MATCH_SCHEMA))


def teams(spark):
    names = spark.range(997).selectExpr("concat('team', id) AS team", "'g' AS group_id")
    return gold.dim_team(names.union(spark.sql("SELECT 'hot', 'g'")))


SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "256KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "512KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__shuffle__partitions": "16",
}


def test_facts_with_a_hot_team_stay_whole(spark, matches):
    with settings(spark, **SMALL):
        facts = gold.fact_matches(matches, teams(spark))
        got = facts.selectExpr("count(match_id)", "count(DISTINCT match_id)", "count(home_team_id)", "count(away_team_id)").first()
    assert tuple(got) == (120_000, 120_000, 120_000, 80_000)


def test_hot_partition_is_split_at_run_time(spark, matches):
    dim = teams(spark).selectExpr("team_name AS home_team", "team_id")
    with settings(spark, **SMALL):
        joined = lookup(matches.select("home_team", "match_id", "stage"), dim, ["home_team"], ["match_id"], salts=1)
        assert len(joined.collect()) == 120_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["home_team", "away_team"])
def test_shares_even_out_hot_and_missing_keys(spark, matches, key):
    dim = teams(spark).selectExpr(f"team_name AS {key}", "team_id")
    rows_in = matches.select(key, "match_id")
    with settings(spark, **SMALL, spark__sql__adaptive__enabled="false"):
        joined = lookup(rows_in, dim, [key], ["match_id"], salts=64)
        sizes, plain = (
            [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("team_id")).collect()]
            for df in (joined, rows_in.join(dim, key, "left"))
        )
    assert sum(sizes) == sum(plain) == 120_000
    assert max(sizes) < 2 * 120_000 / 16 and max(plain) >= 40_000


def test_dimensions_of_hot_values(spark, matches):
    assert gold.dim_stadium(matches).count() == 1
    players = matches.selectExpr("home_team AS player_name", "'t' AS team", "stage AS position")
    dim = gold.dim_player(players)
    assert dim.count() == 998
    plan = dim._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_hot_conversation_is_numbered_in_blocks(spark):
    chat = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, -1, id) AS conv_id", "id AS turn", "'user' AS role", "'t' AS text")
    got = retrieval.chat_history(chat)
    hot = got.where("conv_id = -1").selectExpr("max(position) AS last", "count(DISTINCT position) AS n", "sum(int(turn = (position - 1) * 3)) AS right")
    assert tuple(hot.first()) == (10_000, 10_000, 10_000)


def test_hot_path_of_a_feed(spark, tmp_path):
    lines = spark.range(9000).selectExpr("if(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "id AS at")
    source = str(tmp_path / "in")
    lines.repartition(3).write.json(source)
    schema = "k string, at bigint"
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(source)
    assert feeds.upsert_feed(feed, ["k"], ["at"], str(tmp_path / "t"), str(tmp_path / "o"), 60)
    got = feeds.current_rows(spark, str(tmp_path / "t"), schema, ["k"], ["at"])
    assert got.count() == 6001 and rows(got.where("k = 'hot'")) == [("hot", 8997)]
    assert spark.read.schema(schema).parquet(f"{tmp_path}/t/batch_id=*").where("k = 'hot'").count() == 3
