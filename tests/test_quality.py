from conftest import rows

from touchline import fixed_values as fv
from touchline.operators import quality


def players(spark, *data):
    return spark.createDataFrame(list(data), "Player_Name string, Country string, Age int, Position string, "
                                             "Minutes_Played int, Goals int, Performance_Rating double")


def failures(df):
    return {(r["rule"], r["column"]): r["unexpected"] for r in quality.report(df, quality.player_suite()).collect() if not r["success"]}


def test_good_rows_pass(spark):
    df = players(spark, ("A", "X", 15, "FW", 0, 0, 0.0), ("B", "Y", 50, "Goalkeeper", 90, 1, 10.0),
                 ("C", "Z", None, None, None, None, None))
    assert failures(df) == {}
    assert quality.validate(df)


def test_each_rule_fails_once(spark):
    df = players(spark, (None, "X", 14, "Winger", -1, -1, 10.1), ("B", None, 51, "FW", 1, 1, 5.0))
    assert failures(df) == {
        ("not_null", "Player_Name"): 1, ("not_null", "Country"): 1, ("between", "Age"): 2,
        ("between", "Performance_Rating"): 1, ("between", "Minutes_Played"): 1, ("between", "Goals"): 1,
        ("in_set", "Position"): 1,
    }
    assert not quality.validate(df)


def test_missing_column_fails(spark):
    df = players(spark, ("A", "X", 20, "FW", 1, 1, 5.0)).drop("Age")
    assert failures(df) == {("column_exists", "Age"): 1, ("between", "Age"): 1}


def test_empty_input_reports_zero_rows(spark):
    df = players(spark)
    report = quality.report(df, quality.player_suite())
    assert report.count() == len(quality.player_suite()) == len(fv.REQUIRED_COLUMNS) + 7
    assert rows(report.select("total", "unexpected").distinct()) == [(0, 0)]


def test_one_pass(spark):
    df = players(spark, ("A", "X", 20, "FW", 1, 1, 5.0))
    plan = quality.report(df, quality.player_suite())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
