import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.functions import calendar, cleaning
from touchline.functions.keys import composite_key, name_key
from touchline.workload.numeric import comparable, exact_sum
from touchline.operators import bands, dedup


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    df = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, target, want", [
    ("12", "int", 12), (" 12 ", "int", 12), ("12.7", "int", 12), ("-3.9", "int", -3), ("abc", "int", None),
    ("99999999999", "int", None), ("", "int", None), (None, "int", None), ("1.5", "double", 1.5),
    ("1e3", "double", 1000.0), ("x", "double", None), (".5", "double", 0.5), ("5.", "double", 5.0),
    ("12", "bigint", 12), ("1.2.3", "double", None),
])
def test_soft_cast_of_text(spark, text, target, want):
    assert one(spark, cleaning.soft_cast(F.col("v"), target), v=("string", text)) == want


def test_coerce_shapes_to_schema(spark):
    df = spark.createDataFrame([("7", 2.9, 5_000_000_000)], "a string, b double, c bigint")
    out = cleaning.coerce(df, "a INT, b INT, c INT, d DOUBLE, e STRING")
    assert out.dtypes == [("a", "int"), ("b", "int"), ("c", "int"), ("d", "double"), ("e", "string")]
    assert tuple(out.first()) == (7, 2, None, None, None)


@pytest.mark.parametrize("home, away, want", [
    (2, 1, "HOME_WIN"), (1, 2, "AWAY_WIN"), (1, 1, "DRAW"), (None, 2, "DRAW"), (2, None, "DRAW"), (None, None, "DRAW"),
])
def test_outcome(spark, home, away, want):
    assert one(spark, cleaning.outcome(F.col("h"), F.col("a")), h=("int", home), a=("int", away)) == want


@pytest.mark.parametrize("value, want", [("FW", "Forward"), ("Forward", "Forward"), ("Winger", "Winger"), (None, None)])
def test_canonical_position(spark, value, want):
    assert one(spark, cleaning.canonical(F.col("p"), fv.POSITION_ALIASES), p=("string", value)) == want


@pytest.mark.parametrize("value, want", [("Forward", "Attack"), ("Goalkeeper", "Defense"), ("Winger", "Unknown"), (None, "Unknown")])
def test_rollup_category(spark, value, want):
    assert one(spark, cleaning.rollup_category(F.col("p"), fv.POSITION_CATEGORY), p=("string", value)) == want


@pytest.mark.parametrize("n, d, want", [(3, 2, 1.5), (3, 0, 0.0), (3, None, 0.0), (0, 5, 0.0)])
def test_ratio(spark, n, d, want):
    assert one(spark, cleaning.ratio(F.col("n"), F.col("d")), n=("int", n), d=("int", d)) == want


@pytest.mark.parametrize("value, want", [(1, True), (0, False), (-1, False), (None, False)])
def test_is_positive(spark, value, want):
    assert one(spark, cleaning.is_positive(F.col("v")), v=("int", value)) is want


@pytest.mark.parametrize("text, want", [
    ("**bold** and # head", "bold and  head"),
    ("see [the page](http://x.y/z) now", "see the page now"),
    ("1. first 2. second", "1 first 2 second"),
    ("3.14 and 10.", "314 and 10"),
    ("a.b 1..", "a.b 1."),
    (" \t\n text  \x1f", "text"),
    ("٣. item", "٣ item"),
    ("", ""),
])
def test_strip_markup(spark, text, want):
    assert one(spark, cleaning.strip_markup(F.col("t")), t=("string", text)) == want


def test_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", "\\N"), ("a", ""), (None, "a"), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(composite_key("x", "y")).collect()]
    assert len(keys) == 5 and all(len(k) == 64 for k in keys)
    assert len({keys[0], keys[2], keys[3], keys[4]}) == 4
    assert one(spark, name_key("v"), v=("string", None)) is None
    assert one(spark, name_key("v"), v=("string", "a")) == (
        "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"
    )


def test_calendar(spark):
    parts = calendar.calendar_parts(F.col("d"))
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2025, 1, 4),)], "d date")
    got = rows(df.select(*[c.alias(n) for n, c in parts.items()]))
    assert got[0] == (20241230, dt.date(2024, 12, 30), 2024, 12, 30, 1, "Monday", False)
    assert got[1] == (20250104, dt.date(2025, 1, 4), 2025, 1, 4, 1, "Saturday", True)
    assert one(spark, calendar.parse_timestamp(F.col("t")), t=("string", "not a time")) is None


def test_exact_sum_ignores_order_and_partitioning(spark):
    values = [0.1] * 1000 + [1e9, -1e9, 0.7, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    sums = {df.repartition(n).agg(exact_sum("v")).first()[0] for n in (1, 3, 7)}
    assert sums == {100.7}
    assert df.where("v IS NULL").agg(exact_sum("v")).first()[0] is None
    assert spark.range(100_000).selectExpr("9.9e11D AS v").agg(exact_sum("v")).first()[0] == 9.9e16
    shown = spark.createDataFrame([(0.03125,), (0.03125 - 1e-16,), (2 / 3,), (None,)], "v double").select(comparable(F.col("v")))
    assert [r[0] for r in shown.collect()] == [0.0313, 0.0313, 0.6667, None]
    huge = spark.createDataFrame([(1e300,), (1.0,)], "v double")
    assert huge.agg(exact_sum("v")).first()[0] == 1e300
    odd = spark.createDataFrame([(float("nan"),), (1.0,)], "v double").agg(exact_sum("v")).first()[0]
    assert odd != odd


def test_first_and_latest_by(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), (None, 1, "n")], "k string, v int, w string")
    assert rows(dedup.first_by(df, ["k"])) == [("a", 1, "y"), ("b", None, "q"), (None, 1, "n")]
    assert rows(dedup.latest_by(df, ["k"], ["v"])) == [("a", 2, "x"), ("b", None, "q"), (None, 1, "n")]
    assert rows(dedup.first_by(df.select("k"), ["k"])) == [("a",), ("b",), (None,)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    latest = dedup.latest_by(hot.repartition(4), ["k"], ["v"])
    assert latest.where("k = 0").first()["v"] == 29997
    assert latest.count() == 20001
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


@pytest.mark.parametrize("value, want", [(-1, "blue"), (0, "blue"), (5, "green"), (9.9, "green"), (10, "red"), (None, None)])
def test_band(spark, value, want):
    assert one(spark, bands.band(F.col("v"), fv.TOTAL_GOALS_STEPS), v=("double", None if value is None else float(value))) == want


def test_percent_of_range(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    got = rows(df.select(bands.percent_of_range(F.col("v"), F.lit(0.0), F.lit(10.0))))
    assert [r[0] for r in got] == [0.0, 100.0, 50.0]
    assert df.select(bands.percent_of_range(F.col("v"), F.lit(3.0), F.lit(3.0))).first()[0] == 100.0


def test_last_not_null(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("b", 1, None)], "s string, t int, v int")
    assert rows(bands.last_not_null(df, ["s"], "v", ["t"])) == [("a", 5)]
