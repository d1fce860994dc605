"""The library's operators run over the driver's tables (``sf_dir``).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle of the same name.  The operational tables come
from ``testdata_model.operational_tables``; the rest read driver tables
directly.  Nothing here caps, samples or filters rows to make a check cheap.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.fixed_values import KIT_PICKUP_STOCK_NAMES, SHIRT_STOCK_NAMES
from rollcall.functions.dates import local_date, purchased_between
from rollcall.functions.labels import age_band, age_years, payment_label, refund_mark
from rollcall.operators.batching import number_batches, select_batch
from rollcall.operators.catalogue import list_editions
from rollcall.operators.collation import join_collated
from rollcall.operators.fanout import keep_unused_fanout, without_partial_cancel
from rollcall.operators.lookup import (PROVIDER_ORDER, lookup_provider, pending_requests, provider_counters,
                                       resolve_addresses)
from rollcall.operators.options import option_answers, unnest_options
from rollcall.operators.postal import normalise_postal_codes, profile_postal_codes
from rollcall.operators.report import join_addresses
from rollcall.operators.sizing import broadcast_if_small
from rollcall.operators.trades import correlate_trades
from rollcall.plans.extract import checkout_tickets, extract_forms, extract_participants
from rollcall.plans.testdata_model import (landed_responses, operational_tables, postal_answer,
                                            read_driver_table)
from rollcall.session import materialize, scratch_folder
from rollcall.sources.sinks import edition_label
from rollcall.streaming.latest import AnswerTable, open_answers, upsert_answers

# Parameters of the bound queries (kept equal to the oracle SQL).
EDITION = "ASIA"
EXCLUDED_EVENTS = (7,)
FIRST, LAST = "1996-01-01", "1999-12-31"
AS_OF = dt.date(2025, 6, 30)
ROWS_PER_BATCH = 2500
EXTRACT_BATCH = 1000
ANSWER_BUCKETS = 8


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_driver_table(spark, sf_dir, name)


def _model(spark, sf_dir):
    return operational_tables(spark, sf_dir)


# -- catalogue ---------------------------------------------------------------
def q_edition_catalogue(spark, sf_dir):
    return list_editions(_t(spark, sf_dir, "part"), "WIDGET", col="p_name").select(F.col("p_name").alias("edition"))


def q_edition_catalogue_all(spark, sf_dir):
    return list_editions(_t(spark, sf_dir, "part"), None, col="p_type").select(F.col("p_type").alias("edition"))


def q_edition_catalogue_wildcard(spark, sf_dir):
    return list_editions(_model(spark, sf_dir)["eventcomplement"], "a_i").select(
        F.col("globalEvent").alias("edition"))


# -- dates -------------------------------------------------------------------
def q_local_date_range(spark, sf_dir):
    ev = purchased_between(_t(spark, sf_dir, "events"), "ts", "2024-01-05", "2024-01-20")
    return ev.select("event_id", "user_id", local_date("ts").alias("data_compra"))


# -- star joins --------------------------------------------------------------
def _paid_edition_participants(m):
    sessions = m["checkoutsession"].filter(F.col("status") == "Paid").select(F.col("id").alias("__session"))
    people = m["checkoutparticipant"].select(F.col("id").alias("item_id"), F.col("sessionId").alias("__session"),
                                             F.col("checkoutEventTicketBatchPriceId").alias("__cprice"))
    return (people.join(sessions, "__session")
                  .join(checkout_tickets(m, EDITION, EXCLUDED_EVENTS), "__cprice"))


def q_paid_star_join(spark, sf_dir):
    p = _paid_edition_participants(_model(spark, sf_dir))
    return p.select("item_id", F.col("__session").alias("order_id"), F.col("__edition").alias("edition"),
                    F.col("__event_title").alias("event"), F.col("__ticket_name").alias("ticket"))


def q_label_left_joins(spark, sf_dir):
    """Ticket type, race, payment and insurance of every participant, whatever the edition."""
    m = _model(spark, sf_dir)
    pr = m["eventticketbatchprice"].select(F.col("id").alias("__price"), F.col("typeId").alias("__type"),
                                           F.col("ticketBatchId").alias("__batch"))
    bt = m["eventticketbatch"].select(F.col("id").alias("__batch"), F.col("ticketId").alias("__ticket"))
    cp = m["checkouteventticketbatchprice"].select(F.col("id").alias("__cprice"),
                                                   F.col("eventTicketBatchPriceId").alias("__price"))
    p = (m["checkoutparticipant"].select(F.col("id").alias("item_id"), F.col("sessionId").alias("__session"),
                                         F.col("checkoutEventTicketBatchPriceId").alias("__cprice"))
         .join(cp, "__cprice").join(broadcast_if_small(pr.join(bt, "__batch")), "__price"))
    types = m["eventticketbatchpricetype"].select(F.col("id").alias("__type"), F.col("name").alias("ticket_type"))
    races = m["eventticketcomplement"].select(F.col("ticketId").alias("__ticket"), F.col("nameParsed").alias("race"))
    pays = m["checkoutpayment"].select(F.col("sessionId").alias("__session"), F.col("paymentOption").alias("payment"))
    summ = m["checkoutsummary"].select(F.col("sessionId").alias("__session"),
                                       F.col("ticketInsurance").alias("insurance"))
    p = (p.join(broadcast_if_small(types), "__type", "left").join(broadcast_if_small(races), "__ticket", "left")
          .join(pays, "__session", "left").join(summ, "__session", "left"))
    return p.select("item_id", "ticket_type", "race", "payment", "insurance")


# -- row multiplicity ----------------------------------------------------------
def _lineitem_cancels(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("participantId"), F.when(F.col("l_returnflag") == "R", F.lit("R")).alias("reason"))


def q_cancel_reason_null(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return without_partial_cancel(orders, _lineitem_cancels(spark, sf_dir), "o_orderkey")


def q_unused_fanout_join(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    fanned = keep_unused_fanout(orders, _t(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")
    return fanned.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


# -- collation -----------------------------------------------------------------
def q_collated_join(spark, sf_dir):
    m = _model(spark, sf_dir)
    q = m["formFieldsPlaceholderParsed"].select(F.col("fieldId").alias("q_field"), "placeholderParsed")
    a = m["formfieldanswer"]
    j = join_collated(a, "fieldId", q, "q_field", "UNICODE_CI_AI")
    return j.select(F.col("checkoutParticipantId").alias("participant_id"), F.col("fieldId").alias("field_id"),
                    F.col("placeholderParsed").alias("question"))


def q_collated_segments(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer")
    left = cust.select("c_custkey", F.lower("c_mktsegment").alias("segment"))
    labels = cust.select("c_mktsegment").distinct().select(
        F.translate(F.upper("c_mktsegment"), "AEIOU", "ÁÉÍÓÚ").alias("label"))
    return join_collated(left, "segment", labels, "label", "UNICODE_CI_AI").select("c_custkey", "segment", "label")


def q_answer_filter(spark, sf_dir):
    conv = _t(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        F.expr("CASE WHEN role = 'system' THEN 'true' WHEN role = 'user' AND turn = 0 THEN 'null' "
               "WHEN role = 'user' THEN NULL ELSE text END").alias("answer"))
    kept = conv.filter((F.col("answer") != "true") & (F.col("answer") != "null"))
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return kept.join(orders, F.col("conv_id") == F.col("o_orderkey")).select("conv_id", "turn", "o_orderstatus",
                                                                            "answer")


# -- options -------------------------------------------------------------------
def _options(spark, sf_dir, names, fields, key):
    m = _model(spark, sf_dir)
    return option_answers(unnest_options(m["participant_options"]), m["eventticketstockitems"],
                          m["eventticketstockitemscomplement"], m["eventticketstock"], names, fields, key)


def q_option_shirts(spark, sf_dir):
    return _options(spark, sf_dir, SHIRT_STOCK_NAMES, {"nameParsed": "shirt"}, "participant_id")


def q_option_kit_pickup(spark, sf_dir):
    return _options(spark, sf_dir, KIT_PICKUP_STOCK_NAMES, {"day": "pickup_day", "hour": "pickup_hour"},
                    "participant_id")


# -- trades ----------------------------------------------------------------------
def q_trade_correlation(spark, sf_dir):
    m = _model(spark, sf_dir)
    people = m["checkoutparticipant"].select(F.col("id").alias("item_id"))
    return correlate_trades(people, m["tradecheckoutsession"], m["checkoutparticipant"], "item_id")


# -- batches ---------------------------------------------------------------------
def q_batch_numbering(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id")
    return number_batches(ev, ["event_id"], ROWS_PER_BATCH, stage_input=False)


LINEITEM_ORDER = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def q_batch_numbering_ties(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return number_batches(li, list(LINEITEM_ORDER), ROWS_PER_BATCH, stage_input=False)


def q_batch_slice(spark, sf_dir):
    return select_batch(q_batch_numbering(spark, sf_dir), 2)


def q_row_cap(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id")
    return number_batches(ev, ["event_id"], ROWS_PER_BATCH, max_rows=5000, stage_input=False)


# -- labels ----------------------------------------------------------------------
def q_payment_label(spark, sf_dir):
    m = _model(spark, sf_dir)
    s = m["checkoutsession"].select(F.col("id").alias("order_id"))
    pays = m["checkoutpayment"]
    return s.join(pays, F.col("order_id") == F.col("sessionId"), "left").select(
        "order_id", payment_label("paymentOption").alias("payment_method"))


def q_age_band(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 2 - 15).alias("age"))
    return part.select("p_partkey", "age", age_band("age").alias("age_band"))


def q_age_at(spark, sf_dir):
    p = _model(spark, sf_dir)["checkoutparticipant"]
    age = age_years("birthDate", AS_OF)
    return p.select(F.col("id").alias("item_id"), F.col("birthDate").alias("birth_date"), age.alias("age"),
                    age_band(age).alias("age_band"))


def q_refund_flag(spark, sf_dir):
    m = _model(spark, sf_dir)
    s = m["checkoutsession"].select(F.col("id").alias("order_id"))
    return s.join(m["checkoutsummary"], F.col("order_id") == F.col("sessionId"), "left").select(
        "order_id", refund_mark("ticketInsurance").alias("refundable"))


# -- postal codes ------------------------------------------------------------------
def _answers(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("participant_id"),
                                              postal_answer().alias("cep"))


def _normalised(spark, sf_dir):
    return normalise_postal_codes(_answers(spark, sf_dir))


def q_postal_normalise(spark, sf_dir):
    return _normalised(spark, sf_dir)


def q_postal_profile(spark, sf_dir):
    return profile_postal_codes(_answers(spark, sf_dir))


# -- lookup --------------------------------------------------------------------------
def _provider(name):
    def run(spark, sf_dir):
        forms = _normalised(spark, sf_dir)
        rows, _ = lookup_provider(forms, landed_responses(forms), name)
        return rows
    run.__name__ = f"q_provider_parse_{name}"
    return run


def q_provider_counters(spark, sf_dir):
    forms = _normalised(spark, sf_dir)
    return provider_counters(forms, landed_responses(forms))


def _resolved(spark, sf_dir):
    forms = _normalised(spark, sf_dir)
    return resolve_addresses(forms, landed_responses(forms))


def q_address_fallback(spark, sf_dir):
    return _resolved(spark, sf_dir).addresses


def q_fallback_counters(spark, sf_dir):
    return _resolved(spark, sf_dir).counters


def q_unresolved_codes(spark, sf_dir):
    return _resolved(spark, sf_dir).unresolved.select("participant_id", "parsed_ceps")


def q_pending_requests(spark, sf_dir):
    forms = _normalised(spark, sf_dir)
    return pending_requests(forms, landed_responses(forms))


def q_report_join(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item_id"), "o_custkey", "o_orderstatus")
    return join_addresses(orders, _resolved(spark, sf_dir).addresses)


def q_edition_label(spark, sf_dir):
    return edition_label(_t(spark, sf_dir, "part"), "p_name")


# -- whole extractions and the report --------------------------------------------------
def q_forms_extract(spark, sf_dir):
    return extract_forms(_model(spark, sf_dir), EDITION, FIRST, LAST, rows_per_batch=ROWS_PER_BATCH)


def q_participants_extract(spark, sf_dir):
    return extract_participants(_model(spark, sf_dir), EDITION, FIRST, LAST, rows_per_batch=ROWS_PER_BATCH,
                                as_of=AS_OF, excluded_events=EXCLUDED_EVENTS)


def q_participant_report(spark, sf_dir):
    """The whole job: both extractions, cleaning, fallback lookup, report join."""
    from rollcall.plans.report import build_report
    m = _model(spark, sf_dir)

    def responses_for(forms):
        return landed_responses(forms)

    return build_report(m, responses_for, EDITION, FIRST, LAST, AS_OF, rows_per_batch=ROWS_PER_BATCH,
                        excluded_events=EXCLUDED_EVENTS).report


def q_report_by_batches(spark, sf_dir):
    """The report of every batch of a written extract, each from its own form rows: together the whole report."""
    from rollcall.plans.report import extract_edition, report_from_extract
    from rollcall.sources.readers import read_extract
    from rollcall.sources.sinks import write_extract
    people, forms = extract_edition(_model(spark, sf_dir), EDITION, FIRST, LAST, AS_OF, rows_per_batch=EXTRACT_BATCH,
                                    excluded_events=EXCLUDED_EVENTS)
    base = f"{scratch_folder(spark)}/rollcall-extract-{uuid.uuid4().hex}"
    write_extract(people, f"{base}/participants", "edition", edition=EDITION)
    write_extract(forms, f"{base}/forms", "edicao", edition=EDITION)
    people, forms = read_extract(spark, base, EDITION)
    landed = materialize(landed_responses(forms), "responses")
    last = people.agg(F.max("batch_number")).first()[0] or 1
    return report_from_extract(people, forms, landed, range(1, last + 1)).report


def q_latest_answers(spark, sf_dir):
    """``address_fallback`` from a bucketed answer table that two overlapping landings were added to."""
    forms = _normalised(spark, sf_dir)
    landed = landed_responses(forms)
    name = f"rollcall_answers_{uuid.uuid4().hex}"
    table = open_answers(spark, AnswerTable(name, f"{scratch_folder(spark)}/{name}", ANSWER_BUCKETS))
    upsert_answers(landed.filter(F.col("provider") != PROVIDER_ORDER[0]), table)
    upsert_answers(landed, table)
    found = resolve_addresses(forms, table.read(spark), buckets=table.buckets).addresses
    spark.sql(f"DROP TABLE {name}")      # the files stay; the result reads the written decisions
    return found


QUERIES = {
    "edition_catalogue": q_edition_catalogue,
    "edition_catalogue_all": q_edition_catalogue_all,
    "edition_catalogue_wildcard": q_edition_catalogue_wildcard,
    "local_date_range": q_local_date_range,
    "paid_star_join": q_paid_star_join,
    "label_left_joins": q_label_left_joins,
    "cancel_reason_null": q_cancel_reason_null,
    "unused_fanout_join": q_unused_fanout_join,
    "collated_join": q_collated_join,
    "collated_segments": q_collated_segments,
    "answer_filter": q_answer_filter,
    "option_shirts": q_option_shirts,
    "option_kit_pickup": q_option_kit_pickup,
    "trade_correlation": q_trade_correlation,
    "batch_numbering": q_batch_numbering,
    "batch_numbering_ties": q_batch_numbering_ties,
    "batch_slice": q_batch_slice,
    "row_cap": q_row_cap,
    "payment_label": q_payment_label,
    "age_band": q_age_band,
    "age_at": q_age_at,
    "refund_flag": q_refund_flag,
    "postal_normalise": q_postal_normalise,
    "postal_profile": q_postal_profile,
    **{f"provider_parse_{name}": _provider(name) for name in PROVIDER_ORDER},
    "provider_counters": q_provider_counters,
    "address_fallback": q_address_fallback,
    "latest_answers": q_latest_answers,
    "fallback_counters": q_fallback_counters,
    "unresolved_codes": q_unresolved_codes,
    "pending_requests": q_pending_requests,
    "report_join": q_report_join,
    "edition_label": q_edition_label,
    "forms_extract": q_forms_extract,
    "participants_extract": q_participants_extract,
    "participant_report": q_participant_report,
    "report_by_batches": q_report_by_batches,
}
