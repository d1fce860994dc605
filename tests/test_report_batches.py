"""Reports of several batches at once."""

import datetime as dt
import functools

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.plans import bindings, report
from rollcall.plans.testdata_model import landed_responses

EDITION = "10 Milhas RJ"


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def extract(spark, tables):
    # a participant in three batches, one with two codes, form rows of nobody
    people = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 2), (2, 3), (2, 4), (4, 5), (5, 5), (6, None)],
                                   "batch_number long, item_id long")
    forms = spark.createDataFrame(
        [(1, 1, "01310-100"), (1, 2, "01234-567"), (1, 2, "01234-568"), (1, 4, "00000-009"), (2, 9, "11111-113"), (2, None, "22222-229")],
        "batch_number long, participant_id long, parsed_ceps string")
    return people, forms, landed_responses(forms)


def test_a_range_of_batches_is_the_sum_of_its_batches(extract):
    each = [report.report_from_extract(*extract, batch) for batch in (2, 3, 4, 5, 6)]
    several = report.report_from_extract(*extract, range(2, 7))
    union = functools.partial(functools.reduce, DataFrame.unionByName)
    assert rows(several.report) == rows(union([r.report for r in each])) != []
    assert rows(several.resolved.addresses.drop("report_batch")) == rows(union([r.resolved.addresses for r in each]))
    every = report.report_from_extract(*extract, range(1, 7))
    whole = report.report_from_extract(*extract)
    assert rows(every.report) == rows(whole.report)
    assert rows(every.resolved.unresolved.drop("report_batch")) == rows(whole.resolved.unresolved) != []
    sums = [F.sum(c).alias(c) for c in whole.resolved.counters.columns]
    assert rows(every.resolved.counters.agg(*sums)) == rows(whole.resolved.counters)
    one = report.report_from_extract(*extract, 1).resolved.counters
    assert rows(every.resolved.counters.filter("report_batch = 1").drop("report_batch")) == rows(one)


def test_lookups_do_not_grow_with_the_batches(spark, tables, monkeypatch):
    monkeypatch.setattr(bindings, "_model", lambda *_: tables)
    for name, value in {"EDITION": EDITION, "FIRST": None, "LAST": None, "AS_OF": dt.date(2025, 6, 30), "EXCLUDED_EVENTS": ()}.items():
        monkeypatch.setattr(bindings, name, value)
    calls = []
    resolve = report.resolve_addresses
    monkeypatch.setattr(report, "resolve_addresses", lambda *a, **k: calls.append(1) or resolve(*a, **k))
    monkeypatch.setattr(bindings, "EXTRACT_BATCH", 1)
    got = bindings.q_report_by_batches(spark, "")
    assert len(calls) == 1 and got.agg(F.max("batch_number")).first()[0] > 3
    whole = bindings.q_participant_report(spark, "")
    assert rows(got.drop("batch_number")) == rows(whole.drop("batch_number"))
