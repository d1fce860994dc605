"""Declared schemas of the operational tables and of our intermediate tables.

The operational DDL is not published; types follow the use of each column in
the extraction queries (ids are joined and ordered, flags compared with 0,
timestamps shifted by hours).  Readers always apply these schemas: inference
would turn an all-digit postal code into a number and drop its leading zeros.
"""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


L, S, I, D, TS = T.LongType(), T.StringType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()

OPERATIONAL = {
    "checkoutparticipant": _struct(
        ("id", L), ("sessionId", L), ("checkoutEventTicketBatchPriceId", L), ("name", S),
        ("surname", S), ("email", S), ("phoneNumber", S), ("cpf", S), ("birthDate", D),
        ("coupon", S), ("trackingCode", S), ("createdAt", TS)),
    "checkoutsession": _struct(("id", L), ("status", S), ("createdAt", TS)),
    "checkoutpayment": _struct(("sessionId", L), ("paymentOption", S)),
    "checkoutsummary": _struct(("sessionId", L), ("ticketInsurance", I)),
    "checkoutorderticketpartialcancel": _struct(("participantId", L), ("reason", S)),
    "checkouteventticketbatchprice": _struct(("id", L), ("eventTicketBatchPriceId", L)),
    "eventticketbatchprice": _struct(("id", L), ("typeId", L), ("ticketBatchId", L)),
    "eventticketbatchpricetype": _struct(("id", L), ("name", S)),
    "eventticketbatch": _struct(("id", L), ("ticketId", L)),
    "eventticket": _struct(("id", L), ("eventId", L), ("name", S)),
    "eventticketcomplement": _struct(("ticketId", L), ("nameParsed", S)),
    "event": _struct(("id", L), ("title", S)),
    "eventcomplement": _struct(("eventId", L), ("globalEvent", S)),
    "tradecheckoutsession": _struct(
        ("participantId", L), ("originalParticipantId", L), ("status", S),
        ("transferValue", T.DecimalType(18, 2)), ("participantName", S), ("participantSurname", S)),
    "participant_options": _struct(("id", L), ("questionIDs", T.ArrayType(L))),
    "eventticketstockitems": _struct(("id", L), ("ticketStockId", L)),
    "eventticketstockitemscomplement": _struct(
        ("stockitemsid", L), ("nameParsed", S), ("day", S), ("hour", S)),
    "eventticketstock": _struct(("id", L), ("name", S)),
    "formfieldanswer": _struct(("checkoutParticipantId", L), ("fieldId", S), ("answer", S)),
    "formFieldsPlaceholderParsed": _struct(
        ("fieldId", S), ("placeholder", S), ("placeholderParsed", S)),
}

# The un-nested option view, for landings that hold it instead of ``participant_options``.
OPTION_VIEW = _struct(("id", L), ("questionIDs", L))

FORMS = _struct(
    ("batch_number", L), ("participant_id", L), ("data_compra", D), ("edicao", S), ("evento", S),
    ("field_id", S), ("pergunta_cadastrada", S), ("pergunta_tratada", S), ("cep", S))

# As ``extract`` writes them: with the cleaned code.
CLEANED_FORMS = T.StructType([*FORMS.fields, T.StructField("parsed_ceps", S), T.StructField("peculiar_ceps", S)])

PARTICIPANTS = _struct(
    ("batch_number", L), ("item_id", L), ("order_id", L), ("purchase_date", D),
    ("participant", S), ("correlated_item_id", L), ("correlated_participant", S),
    ("edition", S), ("event", S), ("race", S), ("ticket", S), ("ticket_type", S),
    ("ticket_tracking", S), ("coupon", S), ("payment_method", S), ("email", S), ("phone", S),
    ("cpf", S), ("birth_date", D), ("age", I), ("age_band", S), ("shirt", S),
    ("refundable", S), ("pickup_day", S), ("pickup_hour", S))

# Tables with rows of every event's buyers; the others are catalogues.
SPANNING = ("checkouteventticketbatchprice", "checkoutparticipant", "checkoutsession", "checkoutpayment", "checkoutsummary",
            "checkoutorderticketpartialcancel", "tradecheckoutsession", "participant_options", "formfieldanswer")

# One landed answer per (provider, requested code); ``body`` is the raw text.
RESPONSES = _struct(("provider", S), ("cep_requested", S), ("body", S), ("fetched_at", TS))

ADDRESS_FIELDS = ("cep", "state", "city", "neighborhood", "street", "service")
ADDRESSES = _struct(("item_id", S), *[(name, S) for name in ADDRESS_FIELDS])

ALL = {**OPERATIONAL, "checkoutparticipant_array_vw": OPTION_VIEW, "forms": FORMS, "participants": PARTICIPANTS,
       "responses": RESPONSES, "addresses": ADDRESSES}

# The driver's TPC-H-like test tables (read with these schemas, never inferred).
DB = T.DoubleType()
DRIVER = {
    "region": _struct(("r_regionkey", I), ("r_name", S)),
    "nation": _struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _struct(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", DB),
                        ("c_mktsegment", S)),
    "supplier": _struct(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", DB)),
    "part": _struct(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                    ("p_retailprice", DB)),
    "orders": _struct(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", DB),
                      ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _struct(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                        ("l_quantity", DB), ("l_extendedprice", DB), ("l_discount", DB), ("l_tax", DB),
                        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _struct(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", DB),
                      ("props", S)),
    "conversations": _struct(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
    "benchmark": _struct(("item_id", L), ("text", S)),
}
