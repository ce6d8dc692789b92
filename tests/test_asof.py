import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from touchline.operators import lookup
from touchline.operators.asof import asof_join
from touchline.plans import gold
from touchline.workload.registry import QUERIES
from touchline.workload.tables import SCHEMAS

START = datetime(2024, 1, 1)


def moment(i):
    return None if i is None else START + timedelta(hours=i)


def data(seed=1, n=1500):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c", None, "rows only"]
    rows = [(i, rng.choice(keys), rng.choice([None, *range(60)] if rng.random() < 0.1 else range(400))) for i in range(n)]
    records = [(rng.choice([k for k in keys if k != "rows only"]), rng.choice([None, *range(400)]), rng.randrange(3), rng.choice([None, 1.5, 2.5])) for _ in range(n // 2)]
    records.append(("records only", 5, 1, 1.0))
    rows += rows[:3]  # repeated rows stay
    return rows, records


def brute(rows, records):
    out = []
    for i, k, at in rows:
        fits = [(s, t, v is not None, v or 0, v) for key, s, t, v in records if None not in (k, at, s) and key == k and s <= at]
        best = max(fits, default=None, key=lambda x: x[:4])
        out.append((i, k, moment(at)) + ((moment(best[0]), best[1], best[4]) if best else (None, None, None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("range_rows", [100_000, 200, 7])
def test_equals_brute_force_whole_and_in_ranges(spark, range_rows):
    rows, records = data()
    left = spark.createDataFrame([(i, k, moment(a)) for i, k, a in rows], "id long, k string, at timestamp").repartition(3)
    right = spark.createDataFrame([(k, moment(s), t, v) for k, s, t, v in records], "k string, since timestamp, tie int, v double")
    found = asof_join(left, right, ["k"], "at", "since", ["tie"], range_rows=range_rows)
    assert found.columns == ["id", "k", "at", "since", "tie", "v"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows, records)


def test_hot_key_is_cut_into_ranges(spark):
    from touchline.operators.asof import _ranges

    line = spark.range(10_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
                                      (F.lit(START).cast("timestamp") + F.make_interval(mins=F.col("id").cast("int"))).alias("_at"))
    sizes = {(r["k"], r["_range"]): r["count"] for r in _ranges(line, ["k"], 500).groupBy("k", "_range").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert sum(hot) == 6666 and max(hot) <= 600 and len(hot) >= 10
    assert all(r == 0 for k, r in sizes if k != "hot")


def test_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", START)], "id long, k string, at timestamp")
    right = spark.createDataFrame([], "k string, since timestamp, v double")
    assert [tuple(r) for r in asof_join(left, right, ["k"], "at", "since").collect()] == [(1, "a", START, None, None)]
    assert asof_join(left.where("false"), right, ["k"], "at", "since").count() == 0


def test_kpis_asof_broadcasts_no_table_of_many_rows(spark, monkeypatch, tmp_path):
    day = [datetime(2024, 1, 1) + timedelta(days=i) for i in range(60)]
    tables = {
        "nation": [(0, "N", 0)],
        "supplier": [(i, f"S{i}", 0, 1.0) for i in range(3)],
        "part": [(i, f"p{i}", f"b{i}", f"t{i}", 1, 1.0) for i in range(40)],
        "orders": [(i, i, "F", 1.0, day[i], "1-URGENT") for i in range(60)],
        "lineitem": [(i, i % 40, (i + j) % 3, j, 1.0, 2.0, 0.5, 0.1, "A", "F", day[i]) for i in range(60) for j in (1, 2)],
    }
    for name, given in tables.items():
        spark.createDataFrame(given, SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    want = rows(QUERIES["kpis_asof"](spark, str(tmp_path)))
    monkeypatch.setattr(lookup, "MOST_BROADCAST_ROWS", 20)
    plans, made = [], gold.bigtable_asof

    def seen(matches, attendance, kpis, *more):
        plans.append(gold._with_attendance(matches, attendance)._jdf.queryExecution().executedPlan().toString())
        return made(matches, attendance, kpis, *more)

    monkeypatch.setattr(gold, "bigtable_asof", seen)
    assert rows(QUERIES["kpis_asof"](spark, str(tmp_path))) == want and len(want) == 60
    # orders to lines and matches to attendance; the teams stay small
    assert plans[0].count("SortMergeJoin") == 2
    assert lookup.bounded(spark.range(20)).join(spark.range(30), "id")._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 1
