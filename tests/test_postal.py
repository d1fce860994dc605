from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.operators.postal import normalise_postal_codes, profile_display, profile_postal_codes

CASES = [
    ("01310-100", "01310-100"),
    ("01310100", "01310-100"),
    ("0131_-1__", "01310-100"),
    ("1310", "13100-000"),
    ("01310-1009", "01310-100"),
    ("12.345-678", "12.34-567"),
    ("", "00000-000"),
    (None, "00000-000"),
    ("abc", "abc00-000"),
]


def test_normalise_fixture_codes(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "participant_id long, cep string")
    got = {r.participant_id: r.parsed_ceps for r in normalise_postal_codes(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_leading_zeros_survive_declared_string(spark):
    df = spark.createDataFrame([("01234567",)], "cep string")
    assert normalise_postal_codes(df).first().parsed_ceps == "01234-567"


def test_peculiar_column_is_null_and_kept(spark):
    df = spark.createDataFrame([("1",)], "cep string")
    row = normalise_postal_codes(df).first()
    assert row.peculiar_ceps is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789_-.a ", max_size=14)), min_size=1, max_size=20))
def test_normalise_is_idempotent_and_nine_chars(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "cep string")
    once = normalise_postal_codes(df)
    twice = normalise_postal_codes(once.select(F.col("parsed_ceps").alias("cep")))
    a = [r.parsed_ceps for r in once.collect()]
    b = [r.parsed_ceps for r in twice.collect()]
    assert a == b
    assert all(len(x) == 9 and x[5] == "-" for x in a)


def test_profile_counts_and_shares(spark):
    codes = ["01310-100", "0131_-1__", "1310", "01310-1009", None]
    df = spark.createDataFrame([(c,) for c in codes], "cep string")
    got = {r.metric: (r.n, r.share) for r in profile_postal_codes(df).collect()}
    assert got["total"] == (5, 1.0)
    assert got["with_underscore"] == (3, 0.6)       # characters, not rows
    assert got["without_hyphen"] == (2, 0.4)        # '1310' and the missing one
    assert got["ok"][0] == 2 and got["too_short"][0] == 2 and got["too_long"][0] == 1
    assert got["peculiar"] == (0, 0.0)


def test_profile_of_empty_input(spark):
    df = spark.createDataFrame([], "cep string")
    got = {r.metric: (r.n, r.share) for r in profile_postal_codes(df).collect()}
    assert got["total"] == (0, None) and got["ok"] == (0, None)


def test_profile_display_text(spark):
    df = spark.createDataFrame([("01310-100",), ("1310",), ("1310",), ("0_",)], "cep string")
    got = {r.label: r["qtde (percent)"] for r in profile_display(profile_postal_codes(df)).collect()}
    assert got["total de ceps"] == "4 (100.00%)"
    assert got["ceps com menos de 8 dígitos"] == "3 (75.00%)"
    assert got["ceps com underline"] == "1 (25.00%)"


def _python_clean(cep):
    """The original cleaning, step by step (a missing answer as the documented empty text)."""
    s = "" if cep is None else str(cep)
    s = s.replace("_", "0").replace("-", "")
    s = s.ljust(8, "0") if len(s) < 8 else s[:8]
    return s[0:5] + "-" + s[5:]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12),
                          st.text(alphabet="0123456789_-. çé😀", max_size=12)), min_size=1, max_size=20))
def test_normalise_equals_original_steps(spark, codes):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, cep string")
    got = {r.i: r.parsed_ceps for r in normalise_postal_codes(df).collect()}
    assert got == {i: _python_clean(c) for i, c in enumerate(codes)}


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789_-. a", max_size=12)), min_size=1, max_size=20))
def test_profile_equals_original_counts(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "cep string")
    got = {r.metric: r.n for r in profile_postal_codes(df).collect()}
    raw = ["" if c is None else c for c in codes]
    cleaned = [s.replace("_", "0").replace("-", "") for s in raw]
    assert got == {"total": len(raw), "with_underscore": sum(s.count("_") for s in raw),
                   "without_hyphen": sum("-" not in s for s in raw),
                   "ok": sum(len(s) == 8 for s in cleaned), "too_short": sum(len(s) < 8 for s in cleaned),
                   "too_long": sum(len(s) > 8 for s in cleaned), "peculiar": 0}
