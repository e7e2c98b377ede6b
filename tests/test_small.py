from pyspark.sql import functions as F

from coppice.operators.small import join_on, localised


def test_a_side_is_computed_once_and_read_back(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k")).groupBy("k").count()
    local = localised(df)
    assert local.schema.simpleString() == df.schema.simpleString()
    assert "FileScan parquet" in local._jdf.queryExecution().executedPlan().toString()
    assert sorted(local.collect()) == sorted(df.collect())


def test_join_matches_nulls_and_keeps_one_key(spark):
    big = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, x int")
    side = spark.createDataFrame([("a", 10), (None, 20)], "k string, y int")
    left = join_on(big, side, ["k"], "left")
    assert left.columns == ["k", "x", "y"]
    assert sorted(left.select("x", "y").collect()) == [(1, 10), (2, 20), (3, None)]
