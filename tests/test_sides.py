"""Left joins of many sides in one exchange."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators.fanout import attach_sides


def _tables(spark, seed, hot=0):
    r = random.Random(seed)
    key = lambda: r.choice([None, *range(12)])
    people = [(key(), f"p{i}") for i in range(40)] + [(3, f"hot{i}") for i in range(hot)]
    pays = [(key(), r.choice(["Pix", None])) for _ in range(30)] + [(3, f"pay{i}") for i in range(hot)]
    sums = [(key(), r.choice([0, 1, None]), None) for _ in range(10)]
    none = []
    return (spark.createDataFrame(people, "id long, name string"), spark.createDataFrame(pays, "sid long, pay string"),
            spark.createDataFrame(sums, "k long, flag int, note string"), spark.createDataFrame(none, "e long, extra date"))


def _plain(df, sides):
    for side, key in sides:
        df = df.join(side, F.col("id") == F.col(key), "left").drop(key)
    return df


@pytest.mark.parametrize("seed,hot,bound", [(1, 0, 1000), (2, 60, 20), (3, 5, 0)])
def test_sides_equal_left_joins(spark, seed, hot, bound):
    people, pays, sums, none = _tables(spark, seed, hot)
    sides = [(pays, "sid"), (sums, "k"), (none, "e")]
    got, want = attach_sides(people, "id", sides, bound), _plain(people, sides)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_each_table_is_read_once_and_all_meet_in_one_exchange(spark, tmp_path):
    paths = []
    for i, df in enumerate(_tables(spark, 4)):
        df.write.parquet(str(tmp_path / f"t{i}"))
        paths.append(spark.read.parquet(str(tmp_path / f"t{i}")))
    people, pays, sums, none = paths
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = attach_sides(people, "id", [(pays, "sid"), (sums, "k"), (none, "e")])
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert plan.count("Exchange") == 1 and str(tmp_path) not in plan     # the plan reads the written union only


def test_sides_of_a_hot_key_are_split(spark):
    # 20,000 payments of one session and 3 sessions rows of it
    people = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d")], "id long, name string")
    pays = spark.range(0, 20_000).select(F.lit(1).cast("long").alias("sid"), F.col("id").cast("string").alias("pay"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
                "spark.sql.files.openCostInBytes": "128m"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = attach_sides(people, "id", [(pays.repartition(16), "sid")])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == 60_001
