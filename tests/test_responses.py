import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.functions.responses import has_key, is_object, provider_accepts
from rollcall.operators.lookup import lookup_provider, resolve_addresses

FULL = ('{"cep":"01310100","state":"SP","city":"São Paulo","neighborhood":"Bela Vista",'
        '"street":"Av. Paulista","service":"x"}')
# body -> (accepted by the fallback, provider 1, provider 2, provider 3); None = error row
BODIES = [
    (FULL, True, "ok", "ok", "ok"),
    ('{"cep":null}', True, "ok", "ok", "ok"),
    ('{"errors":[]}', False, "nok", "ok", "ok"),
    ('{"errors":null}', False, "ok", "ok", "ok"),
    ('{"type":"validation_error"}', False, "ok", "nok", "ok"),
    ('{"code":"not_found"}', False, "ok", "ok", "nok"),
    ("{}", False, "ok", "ok", "ok"),
    ("<html>", False, None, None, None),
    ("[1]", False, None, None, None),
    ('"cep"', False, None, None, None),
    ("null", False, None, None, None),
]


def test_acceptance_rules(spark):
    df = spark.createDataFrame([(b,) for b, *_ in BODIES], "body string")
    rows = df.select("body", has_key("body").alias("fallback"), is_object("body").alias("obj"),
                     *[provider_accepts("body", p).alias(p) for p in ("brasilapi", "viacep", "apicep")]).collect()
    for row, (_, fallback, p1, p2, p3) in zip(rows, BODIES):
        assert row.fallback is fallback, row.body
        for got, want in zip((row.brasilapi, row.viacep, row.apicep), (p1, p2, p3)):
            status = ("ok" if got else "nok") if row.obj else None
            assert status == want, row.body


def _responses(spark, rows):
    return spark.createDataFrame(
        [(p, c, b, __import__("datetime").datetime(2024, 2, 1)) for p, c, b in rows],
        "provider string, cep_requested string, body string, fetched_at timestamp_ntz")


def test_fallback_counters_example(spark):
    forms = spark.createDataFrame([(1, "00000-001"), (2, "00000-002"), (3, "00000-003"), (4, "00000-004")],
                                  "participant_id long, parsed_ceps string")
    responses = _responses(spark, [
        ("brasilapi", "00000-001", '{"cep":"1"}'),
        ("brasilapi", "00000-002", '{"errors":["x"]}'), ("viacep", "00000-002", '{"cep":"2"}'),
        ("brasilapi", "00000-003", "<html>"), ("viacep", "00000-003", "[1]"), ("apicep", "00000-003", '{"cep":null}'),
        ("brasilapi", "00000-004", "{}"), ("viacep", "00000-004", "{}"), ("apicep", "00000-004", "{}"),
    ])
    res = resolve_addresses(forms, responses, materialized=True)
    c = res.counters.first().asDict()
    assert c == {"ok": 3, "nok": 1, "brasilapi_errors": 3, "viacep_errors": 2, "apicep_errors": 1}
    addr = {r.item_id: r.cep for r in res.addresses.collect()}
    assert addr == {"1": "1", "2": "2", "3": None}
    assert [r.participant_id for r in res.unresolved.collect()] == [4]


def test_latest_response_wins(spark):
    import datetime as dt
    forms = spark.createDataFrame([(1, "00000-001")], "participant_id long, parsed_ceps string")
    responses = spark.createDataFrame([
        ("brasilapi", "00000-001", '{"errors":["old"]}', dt.datetime(2024, 1, 1)),
        ("brasilapi", "00000-001", '{"cep":"new"}', dt.datetime(2024, 3, 1)),
    ], "provider string, cep_requested string, body string, fetched_at timestamp_ntz")
    assert resolve_addresses(forms, responses).addresses.first().cep == "new"


def test_single_provider_counts_errors_in_neither(spark):
    forms = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "participant_id long, parsed_ceps string")
    responses = _responses(spark, [("viacep", "a", FULL), ("viacep", "b", '{"type":"validation_error"}'),
                                   ("viacep", "c", "<html>")])
    rows, counters = lookup_provider(forms, responses, "viacep")
    assert counters.first().asDict() == {"ok": 1, "nok": 1, "errors": 2}
    got = {r.item_id: (r.status, r.city) for r in rows.collect()}
    assert got == {"1": ("ok", "São Paulo"), "2": ("nok", None), "3": ("error", None), "4": ("error", None)}


def test_unknown_provider_rejected(spark):
    with pytest.raises(ValueError):
        provider_accepts(F.col("body"), "nope")


def test_pending_requests_walk_the_chain(spark):
    from rollcall.operators.lookup import pending_requests
    forms = spark.createDataFrame([(1, "00000-001"), (2, "00000-002"), (3, "00000-003"), (4, "00000-004"),
                                   (5, "00000-005"), (6, "00000-001")], "participant_id long, parsed_ceps string")
    responses = _responses(spark, [
        ("brasilapi", "00000-001", '{"cep":"1"}'),                                         # resolved
        ("brasilapi", "00000-002", '{"errors":["x"]}'),                                    # ask viacep
        ("brasilapi", "00000-003", "<html>"), ("viacep", "00000-003", "{}"),               # ask apicep
        ("brasilapi", "00000-004", "{}"), ("viacep", "00000-004", "{}"), ("apicep", "00000-004", "[1]"),  # done
    ])
    got = sorted((r.provider, r.cep_requested, r.url) for r in pending_requests(forms, responses).collect())
    assert got == [("apicep", "00000-003", "https://cdn.apicep.com/file/apicep/00000-003.json"),
                   ("brasilapi", "00000-005", "https://brasilapi.com.br/api/cep/v1/00000-005"),
                   ("viacep", "00000-002", "https://viacep.com.br/ws/00000-002/json/")]


def _python_rules(body):
    """The original job's view of one body: json.loads + dict access."""
    import json
    d = json.loads(body)
    if not isinstance(d, dict):
        return None
    as_text = lambda v: v if isinstance(v, str) else None  # noqa: E731  (non-strings: JSON text in Spark)
    return ("cep" in d, d.get("errors") is None, d.get("type") != "validation_error",
            d.get("code") != "not_found", as_text(d.get("cep")), as_text(d.get("city")))


_values = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.sampled_from(["validation_error", "not_found", "x", ""]),
                    st.lists(st.integers(0, 2), max_size=2))
_objects = st.dictionaries(st.sampled_from(["cep", "errors", "type", "code", "city", "state", "CEP"]), _values,
                           max_size=5)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(_objects, st.lists(st.integers(), max_size=2), st.integers(), st.none()),
                min_size=1, max_size=15))
def test_rules_equal_python_on_wellformed_json(spark, docs):
    import json
    bodies = [json.dumps(d) for d in docs]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    rows = df.select(is_object("body").alias("o"), has_key("body").alias("k"),
                     provider_accepts("body", "brasilapi").alias("b"), provider_accepts("body", "viacep").alias("v"),
                     provider_accepts("body", "apicep").alias("a"),
                     F.from_json("body", "cep string, city string").alias("f")).collect()
    for body, r in zip(bodies, rows):
        want = _python_rules(body)
        if want is None:
            assert not r.o and not r.k, body
            continue
        assert (r.k, r.b, r.v, r.a) == want[:4], body
        for got, expected in zip((r.f.cep, r.f.city), want[4:]):
            if expected is not None:
                assert got == expected, body
