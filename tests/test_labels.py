import datetime as dt

from pyspark.sql import functions as F

from rollcall.functions.labels import age_band, age_years, full_name, payment_label, refund_mark
from rollcall.operators.report import join_addresses
from rollcall.operators.sizing import broadcast_if_small, has_at_most


def test_age_band_boundaries(spark):
    ages = [None, -5, 0, 20, 21, 30, 31, 40, 41, 50, 51, 60, 61, 99]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r.b for r in df.select(age_band("age").alias("b")).collect()]
    assert got == [None, "até 20 anos", "até 20 anos", "até 20 anos", "de 21 a 30 anos", "de 21 a 30 anos",
                   "de 31 a 40 anos", "de 31 a 40 anos", "de 41 a 50 anos", "de 41 a 50 anos",
                   "de 51 a 60 anos", "de 51 a 60 anos", "acima de 60 anos", "acima de 60 anos"]


def test_age_is_calendar_year_difference(spark):
    df = spark.createDataFrame([(dt.date(2005, 12, 31),), (None,)], "b date")
    assert [r.a for r in df.select(age_years("b", "2025-01-01").alias("a")).collect()] == [20, None]


def test_payment_name_refund(spark):
    df = spark.createDataFrame([(None, "Ana", None, 0), ("Boleto", "Ana", "Lima", 1), ("CreditCard", "b", "c", None),
                                ("Pix", None, "x", 2), ("Voucher", "d", "e", 0)],
                               "p string, n string, s string, f int")
    got = df.select(payment_label("p").alias("p"), full_name("n", "s").alias("n"), refund_mark("f").alias("r")).collect()
    assert [tuple(r) for r in got] == [("Cortesia", None, None), ("Boleto", "ANA LIMA", "X"),
                                       ("Cartão", "B C", "X"), ("Pix", None, "X"), ("Voucher", "D E", None)]


def test_size_check(spark):
    df = spark.range(0, 10)
    assert has_at_most(df, 10) and not has_at_most(df, 9)
    assert "BroadcastHashJoin" in _plan(spark.range(0, 100).join(broadcast_if_small(df, 10), "id"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_join_text_keys(spark):
    people = spark.createDataFrame([(1, "a"), (2, "b"), (12, "c")], "item_id long, name string")
    addresses = spark.createDataFrame(
        [("1", "01310-100", "SP", "São Paulo", "Bela Vista", "Av. Paulista", "x"),
         ("1", "01310-200", "SP", "São Paulo", "Centro", "Rua A", "x"),
         ("x", "00000-000", None, None, None, None, None),
         ("12.0", "11111-111", None, None, None, None, None)],
        "item_id string, cep string, state string, city string, neighborhood string, street string, service string")
    got = sorted((r.item_id, r.cep, r.UF) for r in join_addresses(people, addresses).collect())
    # a malformed key misses instead of failing the job; '12.0' reads as 12; two codes repeat the participant
    assert got == [(1, "01310-100", "SP"), (1, "01310-200", "SP"), (2, None, None), (12, "11111-111", None)]
