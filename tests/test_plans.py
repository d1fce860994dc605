"""Plan-shape regressions: properties that matter at scale, checked on small inputs.

Spark's estimate-based broadcast and AQE are switched off while planning, so
the plans show the library's own choices as they would be on large inputs.
"""

import pytest
from pyspark.sql import functions as F

from rollcall.operators.catalogue import list_editions
from rollcall.operators.collation import join_collated
from rollcall.operators.fanout import without_partial_cancel


@pytest.fixture()
def at_scale(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_collated_join_never_shuffles_the_large_side(at_scale):
    big = at_scale.range(0, 5000).select(
        F.when(F.col("id") % 2 == 0, F.lit("CAMPO-É")).otherwise(F.lit("campo-e")).alias("f"), F.col("id"))
    small = at_scale.createDataFrame([("campo-e", "CEP")], "g string, p string")
    plan = _plan(join_collated(big, "f", small, "g", "UNICODE_CI_AI"))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning(collate(f" not in plan.replace(" ", "")


def test_catalogue_distinct_is_partially_aggregated(at_scale):
    df = at_scale.range(0, 100).select((F.col("id") % 3).cast("string").alias("globalEvent"))
    plan = _plan(list_editions(df))
    assert plan.count("HashAggregate") >= 2      # partial (map side) and final


def test_cancellations_are_aggregated_before_the_join(at_scale):
    people = at_scale.range(0, 100).withColumnRenamed("id", "pid")
    cancels = at_scale.range(0, 1000).select((F.col("id") % 7).alias("participantId"),
                                             F.lit(None).cast("string").alias("reason"))
    plan = _plan(without_partial_cancel(people, cancels, "pid"))
    # only the one-row-per-key counts reach the join (read from their written table),
    # never the raw cancellations
    assert "ReadSchema: struct<__rc_fan_key:bigint,__rc_fan_copies:bigint>" in plan
    assert "participantId" not in plan and "Generate explode" in plan
