import datetime as dt

import pytest

from rollcall.operators.catalogue import list_editions
from rollcall.plans.extract import extract_forms, extract_participants


@pytest.fixture(scope="module")
def forms(tables):
    return extract_forms(tables, "10 Milhas RJ", "2023-12-31", "2024-01-31", rows_per_batch=2).collect()


@pytest.fixture(scope="module")
def people(tables):
    return extract_participants(tables, "10 Milhas RJ", "2023-12-31", "2024-01-31", rows_per_batch=3,
                                as_of=dt.date(2025, 6, 30)).collect()


def test_forms_rows(forms):
    got = sorted((r.participant_id, r.cep, r.data_compra.isoformat(), r.batch_number) for r in forms)
    assert got == [(1, "01310-100", "2023-12-31", 1), (2, "01234567", "2024-01-01", 1),
                   (11, "0131_-1__", "2024-01-08", 2), (12, "1310", "2024-01-08", 2)]


def test_forms_collation_and_answer_filter(forms):
    assert {r.field_id for r in forms} == {"CAMPO-É", "campo-e", "CAMPO-E"}
    assert all(r.pergunta_tratada == "CEP" for r in forms)


def _by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r.item_id, []).append(r)
    return out


def test_participant_multiplicity(people):
    by = _by_id(people)
    # 7: service-shop event; 4: pending; 6: cancelled with reason; 9: other edition
    assert set(by) == {1, 2, 3, 5, 8, 10, 11, 12}
    assert len(by[1]) == 4      # two payments x two shirts (and one trade row)
    assert len(by[3]) == 2      # two ticket complements
    assert len(by[8]) == 1 and len(by[10]) == 2 and len(by[5]) == 1


def test_participant_labels(people):
    by = _by_id(people)
    assert {r.payment_method for r in by[1]} == {"Pix", "Cartão"}
    assert by[3][0].payment_method == "Cortesia" and by[5][0].payment_method == "Voucher"
    assert by[1][0].refundable is None and by[2][0].refundable == "X" and by[5][0].refundable == "X"
    assert by[2][0].participant is None
    assert (by[1][0].age, by[1][0].age_band) == (20, "até 20 anos")
    assert (by[2][0].age, by[2][0].age_band) == (31, "de 31 a 40 anos")
    assert (by[3][0].age, by[3][0].age_band) == (61, "acima de 60 anos")
    assert (by[8][0].age, by[8][0].age_band) == (40, "de 31 a 40 anos")
    assert (by[10][0].age, by[10][0].age_band) == (0, "até 20 anos")
    assert by[5][0].age is None and by[5][0].age_band is None
    assert {r.shirt for r in by[1]} == {"M", "G"}
    assert (by[2][0].pickup_day, by[2][0].pickup_hour) == ("sábado", "10h")


def test_trade_correlation(people):
    by = _by_id(people)
    assert {(r.correlated_item_id, r.correlated_participant) for r in by[1]} == {(2, None)}
    assert {(r.correlated_item_id, r.correlated_participant) for r in by[2]} == {(1, "NOVO DONO")}
    assert by[3][0].correlated_item_id is None   # pending trade


def test_dates_differ_between_extracts(people):
    by = _by_id(people)
    assert by[12][0].purchase_date == dt.date(2023, 12, 31)   # session date, not participant date


def test_batches_are_full(people):
    counts = {}
    for r in people:
        counts[r.batch_number] = counts.get(r.batch_number, 0) + 1
    assert [counts[b] for b in sorted(counts)] == [3, 3, 3, 3, 2]


def test_as_of_required(tables):
    with pytest.raises(ValueError):
        extract_participants(tables, "10 Milhas RJ")


def test_catalogue(tables):
    assert [r.globalEvent for r in list_editions(tables["eventcomplement"], "milhas").collect()] == ["10 Milhas RJ"]
    assert [r.globalEvent for r in list_editions(tables["eventcomplement"]).collect()] == ["10 Milhas RJ", "Outra"]


def test_catalogue_nulls_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "globalEvent string")
    assert [r.globalEvent for r in list_editions(df, "").collect()] == [None, "a", "b"]


def test_unknown_edition_gives_empty_results(tables):
    from rollcall.plans.extract import extract_forms
    people = extract_participants(tables, "Nenhuma", as_of=dt.date(2025, 6, 30), rows_per_batch=3)
    forms = extract_forms(tables, "Nenhuma", rows_per_batch=3)
    assert people.count() == 0 and forms.count() == 0
    assert people.columns[0] == "batch_number" and forms.columns[-1] == "cep"


def test_unnested_option_view_gives_the_same_report(tables):
    from rollcall.operators.options import unnest_options
    with_view = {k: v for k, v in tables.items() if k != "participant_options"}
    with_view["checkoutparticipant_array_vw"] = unnest_options(tables["participant_options"])
    args = ("10 Milhas RJ", "2023-12-31", "2024-01-31")
    a = extract_participants(tables, *args, rows_per_batch=3, as_of=dt.date(2025, 6, 30)).collect()
    b = extract_participants(with_view, *args, rows_per_batch=3, as_of=dt.date(2025, 6, 30)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 14


def test_defaults_keep_every_row(tables):
    """Without bounds or a cap nothing is cut, and null purchase dates stay."""
    every = extract_forms(tables, "10 Milhas RJ", rows_per_batch=2).count()
    assert every >= extract_forms(tables, "10 Milhas RJ", "1900-01-01", "2100-12-31", rows_per_batch=2).count()
    assert extract_forms(tables, "10 Milhas RJ", max_rows=1, rows_per_batch=2).count() == min(1, every)


def test_backslash_in_the_catalogue_fragment(spark):
    from rollcall.operators.catalogue import list_editions
    rows = spark.createDataFrame([("a\\b",), ("a%b",), ("axb",)], "globalEvent string")
    found = lambda c: [r[0] for r in list_editions(rows, c).collect()]
    assert found("a\\b") == ["a\\b"] and found("a\\%b") == ["a%b"] and len(found("a_b")) == 3 and found("\\") == ["a\\b"]
