"""Both extractions on random operational tables, against the plain SQL in DuckDB.

Random tables carry what the hand-made fixture and the driver mapping do not
combine: dangling and null foreign keys, several payments, summaries,
cancellations, trades and option rows per key, duplicated catalogue rows,
accent and case variants of field ids, duplicated collated questions, and
timestamps around both ends of the date range.
"""

import datetime as dt
import random

import duckdb
import pytest

from rollcall.plans.extract import FORMS_COLUMNS, PARTICIPANT_COLUMNS, extract_forms, extract_participants
from rollcall.plans.oracle_sql import FORMS, PARTICIPANTS
from rollcall.sources.schemas import OPERATIONAL

FIRST, LAST = "1996-01-01", "1999-12-31"


def _maybe(rng, value, p=0.2):
    return None if rng.random() < p else value


def _ts(rng):
    base = rng.choice([dt.datetime(1995, 12, 31), dt.datetime(1996, 1, 1), dt.datetime(1998, 6, 1),
                       dt.datetime(1999, 12, 31), dt.datetime(2000, 1, 1)])
    return base + dt.timedelta(hours=rng.randint(0, 26), minutes=rng.choice([0, 59]))


def _rows(seed):
    rng = random.Random(seed)
    r = {}
    r["eventcomplement"] = [(e, rng.choice(["ASIA", "ASIA", "EUROPE", None])) for e in range(10)
                            for _ in range(rng.choice([1, 1, 2]))]
    r["event"] = [(e, f"E{e}") for e in range(10)]
    r["eventticket"] = [(t, rng.randint(0, 11), f"T{t}") for t in range(20)]
    r["eventticketcomplement"] = [(rng.randint(0, 19), _maybe(rng, f"P{k}")) for k in range(25)]
    r["eventticketbatch"] = [(b, rng.randint(0, 21)) for b in range(20)]
    r["eventticketbatchprice"] = [(p, _maybe(rng, rng.randint(0, 3)), rng.randint(0, 21)) for p in range(20)]
    r["eventticketbatchpricetype"] = [(t, f"TYPE{t}") for t in range(3)]
    r["checkouteventticketbatchprice"] = [(c, rng.randint(0, 21)) for c in range(62)]
    r["checkoutsession"] = [(s, rng.choice(["Paid", "Paid", "Pending"]), _ts(rng)) for s in range(40)]
    r["checkoutparticipant"] = [
        (i, _maybe(rng, rng.randint(0, 41), 0.1), rng.randint(0, 61), _maybe(rng, "Ana"), _maybe(rng, "Lima"),
         "a@x", str(i), f"{i:011d}", _maybe(rng, dt.date(rng.randint(1950, 2030), 1, 1)),
         _maybe(rng, "C", 0.7), f"T{i}", _ts(rng)) for i in range(60)]
    r["checkoutpayment"] = [(rng.randint(0, 41), rng.choice(["Pix", "Boleto", "CreditCard", "Voucher", None]))
                            for _ in range(50)]
    r["checkoutsummary"] = [(rng.randint(0, 41), rng.choice([0, 1, None])) for _ in range(30)]
    r["checkoutorderticketpartialcancel"] = [(rng.randint(0, 61), rng.choice([None, None, "x"])) for _ in range(30)]
    r["tradecheckoutsession"] = [(rng.randint(0, 61), rng.randint(0, 61), rng.choice(["Paid", "Pending"]), None,
                                  _maybe(rng, "Novo"), _maybe(rng, "Dono")) for _ in range(25)]
    r["participant_options"] = [(i, [rng.randint(0, 17) for _ in range(rng.randint(0, 3))]) for i in range(60)]
    r["eventticketstockitems"] = [(s, rng.randint(0, 6)) for s in range(16)]
    r["eventticketstock"] = list(enumerate(["Tamanho da Camisa", "Shirt Size", "Retirada de Kit", "Kit Pickup",
                                            "Outro", "Camisa"]))
    r["eventticketstockitemscomplement"] = [(rng.randint(0, 17), _maybe(rng, "M"), _maybe(rng, "sab"), _maybe(rng, "9h"))
                                            for _ in range(20)]
    r["formfieldanswer"] = [(rng.randint(0, 61), rng.choice(["campo-cep", "CAMPO-CÉP", "Campo-Cep", "outro", None]),
                             rng.choice(["01310-100", "true", "null", None, "1310", "0_1"])) for _ in range(90)]
    r["formFieldsPlaceholderParsed"] = [("campo-cep", "Qual o CEP?", "CEP"), ("CAMPO-CEP", "Seu CEP", "CEP"),
                                        ("outro", "Camisa", "OUTRO")]
    return r


def _norm(rows):
    return sorted(repr(tuple(r)) for r in rows)


@pytest.mark.parametrize("seed", [1, 3, 5, 8])
def test_extractions_match_sql_on_random_tables(spark, tmp_path, seed):
    base = str(tmp_path / "ops")
    for name, rows in _rows(seed).items():
        spark.createDataFrame(rows, OPERATIONAL[name]).write.parquet(f"{base}/{name}")
    tables = {n: spark.read.schema(OPERATIONAL[n]).parquet(f"{base}/{n}") for n in OPERATIONAL}
    con = duckdb.connect()
    for n in OPERATIONAL:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{base}/{n}/*.parquet')")
    con.execute("CREATE VIEW checkoutparticipant_array_vw AS "
                "SELECT id, unnest(questionIDs) AS questionIDs FROM participant_options")

    people = extract_participants(tables, "ASIA", FIRST, LAST, rows_per_batch=7, as_of=dt.date(2025, 6, 30),
                                  excluded_events=(7,))
    sql = PARTICIPANTS.replace("/ 2500)", "/ 7)")
    want = con.execute(f"WITH {sql} SELECT {', '.join(PARTICIPANT_COLUMNS)} FROM participants").fetchall()
    assert _norm(people.select(*PARTICIPANT_COLUMNS).collect()) == _norm(want)

    forms = extract_forms(tables, "ASIA", FIRST, LAST, rows_per_batch=5)
    sql = FORMS.replace("/ 2500)", "/ 5)")
    want = con.execute(f"WITH {sql} SELECT {', '.join(FORMS_COLUMNS)} FROM forms").fetchall()
    assert _norm(forms.select(*FORMS_COLUMNS).collect()) == _norm(want)


@pytest.mark.parametrize("seed", [3, 8])
def test_extractions_match_sql_without_any_broadcast(spark, tmp_path, seed, monkeypatch):
    """Every size check refused (huge editions and catalogues): shuffle joins only, hot path forced."""
    import rollcall.operators.fanout as fanout
    import rollcall.operators.sizing as sizing
    monkeypatch.setattr(sizing, "has_at_most", lambda df, max_rows: False)
    monkeypatch.setattr(fanout, "CHUNK_COPIES", 1)
    test_extractions_match_sql_on_random_tables(spark, tmp_path, seed)
