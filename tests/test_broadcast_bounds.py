"""Sides beyond their bound are never sent to the driver, however few bytes they have."""

from pyspark.sql import functions as F

from rollcall.operators.sizing import broadcast_if_small, key_set, restrict


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_sides_beyond_the_bound_are_merge_joined(spark):
    rows = spark.range(2000).select(F.col("id"), (F.col("id") % 7).alias("n"))
    ids = key_set(rows.filter("id < 50"), "id", max_rows=10)
    got = restrict(rows, "id", ids)
    assert "Broadcast" not in executed(got) and got.count() == 50
    assert "Broadcast" in executed(restrict(rows, "id", key_set(rows.filter("id < 50"), "id")))
    side = rows.filter("id < 50").withColumnRenamed("n", "m")
    for how, n in (("inner", 50), ("left", 2000), ("left_semi", 50), ("left_anti", 1950)):
        joined = rows.join(broadcast_if_small(side, 10), "id", how)
        assert "Broadcast" not in executed(joined) and joined.count() == n
