from conftest import rows
from pyspark.sql import functions as F

from touchline.operators.numbering import sequential_id


def test_dense_numbers_in_order_without_a_single_task(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 997).alias("a"), F.when(F.col("id") % 3 > 0, "hot").alias("b"), (F.col("id") % 11).alias("c")).repartition(7)
    made = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be merged
    try:
        found = sequential_id(df, [F.desc("b"), "a"], "n", start=5, made=made)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = [tuple(r) for r in found.orderBy("n").collect()]
    expected = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1] is None, r[0], r[2]))
    assert [g[3] for g in got] == list(range(5, 3005)) and [g[:3] for g in got] == expected
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
    ranges = spark.read.parquet(made[0]).groupBy("_range").count().collect()
    assert len(ranges) > 2 and max(r["count"] for r in ranges) < 2000


def test_numbers_of_nothing_and_of_equal_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (0, "x")], "a int, b string")
    assert rows(sequential_id(df, ["a"])) == [(0, "x", 1), (1, None, 2), (1, None, 3)]
    assert sequential_id(df.where("false"), ["a"]).count() == 0
