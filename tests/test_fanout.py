from pyspark.sql import functions as F

import rollcall.operators.fanout as fanout


def test_cancellation_multiplicity(spark):
    people = spark.createDataFrame([(i,) for i in range(1, 6)], "pid long")
    # none / null reason / real reason / one of each / two null reasons
    cancels = spark.createDataFrame([(2, None), (3, "x"), (4, None), (4, "x"), (5, None), (5, None)],
                                    "participantId long, reason string")
    got = fanout.without_partial_cancel(people, cancels, "pid").groupBy("pid").count().collect()
    assert {r.pid: r["count"] for r in got} == {1: 1, 2: 1, 4: 1, 5: 2}


def test_unused_fanout_counts_every_match(spark):
    people = spark.createDataFrame([(1,), (2,), (None,)], "pid long")
    other = spark.createDataFrame([(1,), (1,), (1,), (3,), (None,)], "k long")
    got = fanout.keep_unused_fanout(people, other, "pid", "k").groupBy("pid").count().collect()
    assert {r.pid: r["count"] for r in got} == {1: 3, 2: 1, None: 1}


def test_hot_participant_is_split_across_tasks(spark, monkeypatch):
    monkeypatch.setattr(fanout, "CHUNK_COPIES", 500)
    people = spark.range(0, 20).withColumnRenamed("id", "pid")
    cancels = spark.range(0, 30000).select(
        F.when(F.col("id") < 25000, F.lit(3)).otherwise(F.col("id") % 20).alias("participantId"),
        F.when(F.col("id") % 7 == 0, F.lit("r")).alias("reason"))
    out = fanout.without_partial_cancel(people, cancels, "pid")
    want = (people.join(cancels, F.col("pid") == F.col("participantId"), "left")
                  .filter(F.col("reason").isNull()).groupBy("pid").count())
    assert sorted(out.groupBy("pid").count().collect()) == sorted(want.collect())
    sizes = out.rdd.glom().map(len).collect()
    assert max(sizes) < 0.5 * sum(sizes)


def test_combined_multiplier_equals_sequential(spark):
    people = spark.createDataFrame([(i,) for i in range(1, 8)], "pid long")
    cancels = spark.createDataFrame([(2, None), (3, "x"), (4, None), (4, "x"), (5, None), (5, None), (7, None)],
                                    "participantId long, reason string")
    trades = spark.createDataFrame([(1,), (1,), (5,), (6,), (6,), (6,), (3,)], "participantId long")
    seq = fanout.keep_unused_fanout(fanout.without_partial_cancel(people, cancels, "pid"), trades, "pid",
                                    "participantId")
    one = fanout.multiply_by_matches(people, "pid", cancels, ((trades, "participantId"),))
    count = lambda d: sorted((r.pid, r["count"]) for r in d.groupBy("pid").count().collect())
    assert count(one) == count(seq) == [(1, 2), (2, 1), (4, 1), (5, 2), (6, 3), (7, 1)]
