"""The bucketed answer table: stream, then lookup."""

import datetime as dt
import uuid

import pytest

from rollcall.operators.lookup import code_winners, resolve_addresses
from rollcall.sources.schemas import RESPONSES
from rollcall.streaming.latest import AnswerTable, compact_answers, open_answers, stream_answers, upsert_answers


def at(day):
    return dt.datetime(2024, 1, day)


FIRST = [("brasilapi", "01310-100", '{"cep":"01310100","city":"Old"}', at(1)), ("brasilapi", "20000-000", "<html>", at(1)),
         ("viacep", "20000-000", '{"cep":"20000000","city":"Rio"}', at(1)), ("viacep", "30000-000", '{"erro":true}', at(1))]
SECOND = [("brasilapi", "01310-100", '{"cep":"01310100","city":"New"}', at(3)), ("brasilapi", "01310-100", '{"x":1}', at(2)),
          ("apicep", "30000-000", '{"cep":"30000000","city":"Belo"}', at(2))]


@pytest.fixture()
def table(spark, tmp_path):
    name = f"answers_{uuid.uuid4().hex}"
    yield open_answers(spark, AnswerTable(name, str(tmp_path / "answers"), 4))
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture()
def forms(spark):
    codes = ["01310-100", "01310-100", "20000-000", "30000-000", "99999-999", None]
    return spark.createDataFrame(list(enumerate(codes)), "participant_id long, parsed_ceps string")


def _found(forms, table, spark):
    r = resolve_addresses(forms, table.read(spark), buckets=table.buckets, materialized=True)
    return {x.item_id: x.city for x in r.addresses.collect()}, r.counters.first().asDict(), r.unresolved.count()


def test_stream_then_lookup(spark, tmp_path, table, forms):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ckpt")
    assert _found(forms, table, spark)[0] == {}
    spark.createDataFrame(FIRST, RESPONSES).write.mode("append").parquet(source)
    stream_answers(spark, source, table, checkpoint).awaitTermination(120)
    assert _found(forms, table, spark)[0] == {"0": "Old", "1": "Old", "2": "Rio"}
    spark.createDataFrame(SECOND, RESPONSES).write.mode("append").parquet(source)
    stream_answers(spark, source, table, checkpoint).awaitTermination(120)
    want = ({"0": "New", "1": "New", "2": "Rio", "3": "Belo"},
            {"ok": 4, "nok": 2, "brasilapi_errors": 4, "viacep_errors": 3, "apicep_errors": 2}, 2)
    assert _found(forms, table, spark) == want
    # the same landing once more, from a lost checkpoint: every micro-batch is replayed
    stream_answers(spark, source, table, str(tmp_path / "ckpt2")).awaitTermination(120)
    assert _found(forms, table, spark) == want
    compact_answers(spark, table)
    assert table.read(spark).count() == 5 and _found(forms, table, spark) == want
    # another session names the same files again
    spark.sql(f"DROP TABLE {table.name}")
    open_answers(spark, table)
    assert _found(forms, table, spark) == want


def test_lookup_in_buckets_shuffles_neither_side(spark, table, forms, tmp_path):
    upsert_answers(spark.createDataFrame(FIRST + SECOND, RESPONSES), table)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    import rollcall.operators.lookup as lookup
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        codes, name = lookup._bucketed(lookup._count_codes(forms, "parsed_ceps"), table.buckets)
        bound = lookup.broadcast_if_small
        lookup.broadcast_if_small = lambda df: df            # as beyond the broadcast bound
        plan = code_winners(table.read(spark), codes)._jdf.queryExecution().executedPlan().toString()
        lookup.broadcast_if_small = bound
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    spark.sql(f"DROP TABLE {name}")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
