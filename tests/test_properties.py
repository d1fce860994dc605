import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.operators.lookup import resolve_addresses
from rollcall.operators.report import join_addresses
from rollcall.plans.extract import extract_participants

BODIES = ['{"cep":"1"}', '{"cep":null}', '{"errors":[]}', '{}', "<html>", "[1]", None]
PROVIDERS = ("brasilapi", "viacep", "apicep")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=25),
       st.dictionaries(st.tuples(st.sampled_from(PROVIDERS), st.integers(0, 5)), st.sampled_from(BODIES)))
def test_fallback_counter_invariants(spark, codes, answers):
    forms = spark.createDataFrame([(i, f"c{c}") for i, c in enumerate(codes)], "participant_id long, parsed_ceps string")
    rows = [(p, f"c{c}", b, dt.datetime(2024, 1, 1)) for (p, c), b in answers.items() if b is not None]
    responses = spark.createDataFrame(rows, "provider string, cep_requested string, body string, fetched_at timestamp_ntz")
    res = resolve_addresses(forms, responses)
    c = res.counters.first().asDict()
    assert c["ok"] + c["nok"] == len(codes)
    assert c["nok"] == c["apicep_errors"]
    assert c["brasilapi_errors"] >= c["viacep_errors"] >= c["apicep_errors"]
    assert res.addresses.count() == c["ok"] and res.unresolved.count() == c["nok"]


def test_report_has_at_least_the_participant_rows(spark, tables):
    people = extract_participants(tables, "10 Milhas RJ", "2023-12-31", "2024-01-31", as_of=dt.date(2025, 6, 30))
    addresses = spark.createDataFrame([("1", "01310-100", "SP", "São Paulo", "x", "y", "z"),
                                       ("1", "01310-200", "SP", "São Paulo", "x", "y", "z")],
                                      "item_id string, cep string, state string, city string, neighborhood string, "
                                      "street string, service string")
    assert join_addresses(people, addresses).count() >= people.count()
