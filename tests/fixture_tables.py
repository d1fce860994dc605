"""Hand-made operational tables holding the edge rows every fixture set needs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import SparkSession

from rollcall.sources.schemas import OPERATIONAL

TS = dt.datetime
D = dt.date


def operational_tables(spark: SparkSession) -> dict:
    rows = {
        "eventcomplement": [(1, "10 Milhas RJ"), (2, "10 Milhas RJ"), (3, "Outra"), (211, "10 Milhas RJ")],
        "event": [(1, "Corrida A"), (2, "Corrida B"), (3, "Outra"), (211, "Loja")],
        "eventticket": [(10, 1, "Ticket 10K"), (20, 2, "Ticket 5K"), (30, 3, "Outro"), (40, 211, "Loja")],
        "eventticketcomplement": [(10, "10K"), (20, "5K"), (20, "5K bis")],
        "eventticketbatch": [(100, 10), (200, 20), (300, 30), (400, 40)],
        "eventticketbatchprice": [(1000, 1, 100), (2000, 2, 200), (3000, 1, 300), (4000, 1, 400)],
        "eventticketbatchpricetype": [(1, "Geral")],
        "checkouteventticketbatchprice": [(1, 1000), (2, 2000), (3, 3000), (4, 4000)],
        # id, session, cprice, name, surname, email, phone, cpf, birth, coupon, tracking, created
        "checkoutparticipant": [
            (1, 11, 1, "Ana", "Silva", "a@x", "1", "111", D(2005, 3, 1), None, "T1", TS(2024, 1, 1, 2, 59, 59)),
            (2, 12, 1, "Bia", None, "b@x", "2", "222", D(1994, 1, 1), "C10", "T2", TS(2024, 1, 1, 3, 0, 0)),
            (3, 13, 2, "Caio", "Lima", "c@x", "3", "333", D(1964, 5, 5), None, "T3", TS(2024, 1, 2, 12, 0)),
            (4, 14, 1, "Duda", "Reis", "d@x", "4", "444", D(2030, 1, 1), None, "T4", TS(2024, 1, 3, 12, 0)),
            (5, 15, 1, "Eva", "Paz", "e@x", "5", "555", None, None, "T5", TS(2024, 1, 4, 12, 0)),
            (6, 16, 1, "Fabi", "Luz", "f@x", "6", "666", D(1965, 1, 1), None, "T6", TS(2024, 1, 5, 12, 0)),
            (7, 17, 4, "Gil", "Loja", "g@x", "7", "777", D(1995, 1, 1), None, "T7", TS(2024, 1, 5, 12, 0)),
            (8, 18, 1, "Hugo", "Mar", "h@x", "8", "888", D(1985, 1, 1), None, "T8", TS(2024, 1, 6, 12, 0)),
            (9, 19, 3, "Ivo", "Sol", "i@x", "9", "999", D(1975, 1, 1), None, "T9", TS(2024, 1, 6, 12, 0)),
            (10, 20, 1, "Juca", "Rio", "j@x", "10", "1010", D(2025, 1, 1), None, "T10", TS(2024, 1, 7, 12, 0)),
            (11, 21, 1, "Lia", "Mel", "l@x", "11", "1111", D(1990, 1, 1), None, "T11", TS(2024, 1, 8, 12, 0)),
            (12, 11, 1, "Mia", "Gil", "m@x", "12", "1212", D(2004, 1, 1), None, "T12", TS(2024, 1, 8, 12, 0)),
        ],
        "checkoutsession": [
            (11, "Paid", TS(2024, 1, 1, 2, 0)), (12, "Paid", TS(2024, 1, 1, 3, 0)),
            (13, "Paid", TS(2024, 1, 1, 12, 0)), (14, "Pending", TS(2024, 1, 3, 12, 0)),
            (15, "Paid", TS(2024, 1, 4, 12, 0)), (16, "Paid", TS(2024, 1, 5, 12, 0)),
            (17, "Paid", TS(2024, 1, 5, 12, 0)), (18, "Paid", TS(2024, 1, 6, 12, 0)),
            (19, "Paid", TS(2024, 1, 6, 12, 0)), (20, "Paid", TS(2024, 1, 7, 12, 0)),
            (21, "Paid", TS(2024, 1, 8, 12, 0)),
        ],
        "checkoutpayment": [(11, "Pix"), (11, "CreditCard"), (12, "Boleto"), (15, "Voucher")],
        "checkoutsummary": [(11, 0), (12, 1), (13, 0)],
        "checkoutorderticketpartialcancel": [
            (5, None), (6, "desistiu"), (8, None), (8, "desistiu"), (10, None), (10, None)],
        "tradecheckoutsession": [
            (1, 2, "Paid", Decimal("10.00"), "Novo", "Dono"),
            (3, 11, "Pending", Decimal("5.00"), "Outro", "Dono")],
        "participant_options": [(1, [500, 501]), (2, [500, 600]), (3, [502, 503]), (11, [])],
        "eventticketstockitems": [(500, 50), (501, 51), (502, 52), (503, 50), (600, 60)],
        "eventticketstockitemscomplement": [
            (500, "M", None, None), (501, "G", None, None), (503, "P", None, None),
            (600, None, "sábado", "10h")],
        "eventticketstock": [(50, "Tamanho da Camisa"), (51, "Shirt Size"), (52, "Outro"), (60, "Kit Pickup")],
        "formfieldanswer": [
            (1, "CAMPO-É", "01310-100"), (2, "campo-e", "true"), (3, "campo-e", "null"),
            (4, "campo-e", None), (11, "CAMPO-E", "0131_-1__"), (12, "campo-e", "1310"),
            (12, "outro", "x"), (2, "campo-e", "01234567")],
        "formFieldsPlaceholderParsed": [("campo-e", "Qual o seu CEP?", "CEP"), ("outro", "Camisa", "CAMISA")],
    }
    return {name: spark.createDataFrame(data, OPERATIONAL[name]) for name, data in rows.items()}
