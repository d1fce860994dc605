from pyspark.sql import functions as F

from rollcall.operators.collation import join_collated


def test_matches_direct_collated_join(spark):
    a = spark.createDataFrame([("CAMPO-É", 1), ("campo-e", 2), ("Campo-E", 3), ("outro", 4), (None, 5),
                               ("campo-e ", 6)], "f string, v int")
    q = spark.createDataFrame([("campo-e", "CEP"), ("CAMPO-E", "CEP2"), ("nada", "X")], "g string, p string")
    c = "UNICODE_CI_AI"
    direct = a.join(q, F.collate(a.f, c) == F.collate(q.g, c)).select("v", "p")
    ours = join_collated(a, "f", q, "g", c).select("v", "p")
    assert sorted(ours.collect()) == sorted(direct.collect())
    assert sorted(r.v for r in ours.collect()) == [1, 1, 2, 2, 3, 3]   # trailing blank stays significant


def test_left_keeps_unmatched(spark):
    a = spark.createDataFrame([("x", 1), ("É", 2), (None, 3)], "f string, v int")
    q = spark.createDataFrame([("e", "E")], "g string, p string")
    got = sorted((r.v, r.p) for r in join_collated(a, "f", q, "g", "UNICODE_CI_AI", how="left").collect())
    assert got == [(1, None), (2, "E"), (3, None)]
