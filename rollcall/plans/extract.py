"""Forms and participant extraction for one edition and purchase-date range.

``tables`` maps operational table names (see ``rollcall.sources.schemas``) to
DataFrames.  Both extractions start from the edition scope: the small ticket
dimension (price -> batch -> ticket -> event -> edition, catalogue tables),
the edition's checkout-price rows and their id set.  Every table that spans
all events is then filtered in its scan by a broadcast key set of the edition
(checkout prices, then participants and sessions), the date range is pushed
into the scan as a half-open instant range, and the row multiplicity of the
original left joins is kept: matches that contribute no column are counted per
key, the others are joined.

Joins read written tables on both sides, so that a hot session, participant
or answer is split by skew handling; rows are repeated last, right before numbering.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.functions.dates import local_date, purchased_between
from rollcall.functions.labels import age_band, age_years, full_name, payment_label, refund_mark
from rollcall.operators.batching import number_batches
from rollcall.operators.collation import join_collated
from rollcall.operators.fanout import (attach_copies, attach_sides, combined_copies, match_copies, null_reason_copies,
                                       repeat_rows)
from rollcall.operators.options import option_answer_groups, unnest_options
from rollcall.operators.sizing import IdSet, broadcast_if_small, key_set, key_sets, restrict
from rollcall.operators.trades import OLD, correlated, trade_roles, trade_sides
from rollcall.session import materialize, run_concurrently

FORMS_COLUMNS = ("batch_number", "participant_id", "data_compra", "edicao", "evento", "field_id",
                 "pergunta_cadastrada", "pergunta_tratada", "cep")
PARTICIPANT_COLUMNS = tuple(fv.PARTICIPANT_DISPLAY_NAMES)


def edition_tickets(tables: dict[str, DataFrame], edition: str, excluded_events=()) -> DataFrame:
    """Ticket batch prices of one edition: ``__price`` -> type, ticket, event, edition."""
    ec = (tables["eventcomplement"].filter(F.col("globalEvent") == F.lit(edition))
          .select(F.col("eventId").alias("__event"), F.col("globalEvent").alias("__edition")))
    ev = tables["event"].select(F.col("id").alias("__event"), F.col("title").alias("__event_title"))
    if excluded_events:
        ev = ev.filter(~F.col("__event").isin(list(excluded_events)))
    tk = tables["eventticket"].select(F.col("id").alias("__ticket"), F.col("eventId").alias("__event"),
                                      F.col("name").alias("__ticket_name"))
    bt = tables["eventticketbatch"].select(F.col("id").alias("__batch"), F.col("ticketId").alias("__ticket"))
    pr = tables["eventticketbatchprice"].select(F.col("id").alias("__price"), F.col("typeId").alias("__type"),
                                                F.col("ticketBatchId").alias("__batch"))
    dim = ec.join(ev, "__event").join(tk, "__event").join(bt, "__ticket").join(pr, "__batch")
    return dim.drop("__batch")


def checked_edition_tickets(tables: dict[str, DataFrame], edition: str) -> DataFrame:
    """``edition_tickets``, written once and marked for broadcast when its size bound holds.

    Its size check and every consumer (checkout prices, ticket types and
    complements) read the written copy instead of re-joining the catalogue.
    """
    return broadcast_if_small(materialize(edition_tickets(tables, edition), "edition-tickets"))


def _edition_dim(tables, edition, excluded_events=(), tickets: DataFrame | None = None) -> DataFrame:
    dim = tickets if tickets is not None else checked_edition_tickets(tables, edition)
    if excluded_events:
        dim = dim.filter(~F.col("__event").isin(list(excluded_events)))
    return dim


def checkout_tickets(tables, edition, excluded_events=(), tickets: DataFrame | None = None) -> DataFrame:
    """``__cprice`` -> edition ticket columns (checkout-level price rows of the edition)."""
    cp = tables["checkouteventticketbatchprice"].select(
        F.col("id").alias("__cprice"), F.col("eventTicketBatchPriceId").alias("__price"))
    return cp.join(_edition_dim(tables, edition, excluded_events, tickets), "__price")


class EditionScope:
    """What the extractions of one edition start from; each part is computed once, when it is first asked for.

    ``shared`` says that both extractions will run.  Then participants, sessions
    and cancellations of the edition are read once, whatever their dates, and
    written for both; otherwise each extraction reads what it needs, with its
    date range pushed into the scan.
    """

    def __init__(self, tables: dict[str, DataFrame], edition: str, shared: bool = False):
        self.tables, self.shared = tables, shared
        self.tickets = checked_edition_tickets(tables, edition)    # broadcast when its row bound holds
        #: The edition's checkout-price rows with their ticket columns (written once), and their id set.
        self.checkout = materialize(checkout_tickets(tables, edition, tickets=self.tickets), "edition-checkout")
        self.cprice_ids = key_set(self.checkout, "__cprice")
        self._lock = threading.RLock()

    def _once(self, name: str, compute):
        with self._lock:
            if name not in self.__dict__:
                self.__dict__[name] = compute()
            return self.__dict__[name]

    @property
    def people(self) -> DataFrame:
        """Participants of the edition with their ticket columns: the participant table is filtered in its scan and written once."""
        return self._once("_people", lambda: materialize(
            restrict(self.tables["checkoutparticipant"], "checkoutEventTicketBatchPriceId", self.cprice_ids).select(
                F.col("id").alias("__pid"), F.col("sessionId").alias("__session"),
                F.col("checkoutEventTicketBatchPriceId").alias("__cprice"), "createdAt",
                full_name("name", "surname").alias("participant"), F.col("trackingCode").alias("ticket_tracking"),
                F.col("coupon"), F.col("email"), F.col("phoneNumber").alias("phone"), F.col("cpf"),
                F.col("birthDate").alias("birth_date")).join(self.checkout, "__cprice"), "edition-people"))

    @property
    def id_sets(self) -> list[IdSet]:
        """Id sets of the edition's participants and of their sessions."""
        return self._once("_id_sets", lambda: key_sets(self.people, "__pid", "__session"))

    def buyers_between(self, first, last) -> DataFrame:
        """Participants of the edition who bought in the range, by their own date, with their tickets; written once."""
        if self.shared:
            found = purchased_between(self.people, "createdAt", first, last)
        else:
            found = restrict(purchased_between(self.tables["checkoutparticipant"], "createdAt", first, last),
                             "checkoutEventTicketBatchPriceId", self.cprice_ids).select(
                F.col("id").alias("__pid"), F.col("sessionId").alias("__session"),
                F.col("checkoutEventTicketBatchPriceId").alias("__cprice"), "createdAt").join(self.checkout, "__cprice")
        return materialize(found.select("__pid", "__session", "__ticket", "__edition", "__event_title",
                                        local_date("createdAt").alias("data_compra")), "edition-buyers")

    def _paid_sessions(self) -> DataFrame:
        return self.tables["checkoutsession"].filter(F.col("status") == F.lit(fv.PAID_STATUS))

    @property
    def _shared_sessions(self) -> DataFrame:
        return self._once("_paid", lambda: materialize(
            restrict(self._paid_sessions(), "id", self.id_sets[1]).select(F.col("id").alias("__session"), "createdAt"), "paid-sessions"))

    def sessions_of(self, buyers: DataFrame) -> DataFrame:
        """``__session``: paid sessions of the buyers."""
        if self.shared:
            return self._shared_sessions.select("__session")
        return restrict(self._paid_sessions(), "id", key_set(buyers, "__session")).select(F.col("id").alias("__session"))

    def sessions_between(self, first, last) -> DataFrame:
        """``__session, purchase_date`` of the edition's paid sessions in the range, by the session's date."""
        if self.shared:
            found = purchased_between(self._shared_sessions, "createdAt", first, last)
        else:
            found = restrict(purchased_between(self._paid_sessions(), "createdAt", first, last), "id", self.id_sets[1]) \
                .withColumnRenamed("id", "__session")
        return found.select("__session", local_date("createdAt").alias("purchase_date"))

    def cancels_of(self, ids: IdSet) -> DataFrame:
        """Cancellations of participants in ``ids`` (of all the edition's, when shared)."""
        table = self.tables["checkoutorderticketpartialcancel"]
        if self.shared:
            return self._once("_cancels", lambda: materialize(restrict(table, "participantId", self.id_sets[0]), "edition-cancels"))
        return restrict(table, "participantId", ids)


def edition_scope(tables: dict[str, DataFrame], edition: str, shared: bool = False) -> EditionScope:
    """The edition's tickets and checkout-price rows, and the id set that filters the participant table.

    The checkout-price table spans every event; it is filtered by the
    broadcast ticket dimension in its scan and the edition's share is
    written once.  Its id set then filters the participant table in its scan,
    so no extraction shuffles the participants of every event.
    """
    return EditionScope(tables, edition, shared)


def _tickets(scope: EditionScope, excluded_events=()) -> DataFrame:
    """Ticket dimension of the scope without the excluded events."""
    if excluded_events:
        return scope.tickets.filter(~F.col("__event").isin(list(excluded_events)))
    return scope.tickets


def _of_edition(catalogue: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows of an all-events catalogue that belong to the edition (semi-join on the small dimension).

    Keeps catalogue tables edition-sized, so their own broadcast check holds
    however many events the catalogue spans.
    """
    return catalogue.join(dim.select(key), key, "left_semi")


def _option_view(tables, ids: DataFrame) -> DataFrame:
    """One row per participant and chosen option id, for the participants in ``ids``.

    Taken from the un-nested view when the landing holds it, else from the
    array column of ``participant_options`` (filtered before the explode).
    """
    if "checkoutparticipant_array_vw" in tables:
        view = tables["checkoutparticipant_array_vw"].select("id", "questionIDs")
        return restrict(view, "id", ids)
    return unnest_options(restrict(tables["participant_options"], "id", ids))


def extract_forms(tables: dict[str, DataFrame], edition: str,
                  first=None, last=None,
                  max_rows: int | None = None,
                  rows_per_batch: int = fv.DEFAULT_ROWS_PER_BATCH,
                  collation: str = fv.FIELD_ID_COLLATION, workdir: str | None = None,
                  scope: EditionScope | None = None) -> DataFrame:
    """Postal-code answers of paid, non-cancelled buyers of ``edition``.

    The purchase date is the participant's own ``createdAt`` (local time).
    The answer's field id is matched to the question catalogue under
    ``collation`` (case and accent insensitive by default).  Rows are numbered
    in batches of ``rows_per_batch`` by participant id (remaining columns break
    ties).  ``max_rows`` keeps the first ones only; without it, and without date
    bounds, every row is kept.  ``scope`` may pass the ``edition_scope``
    shared with the participant extraction.
    """
    questions = (tables["formFieldsPlaceholderParsed"]
                 .filter(F.col("placeholderParsed") == F.lit(fv.POSTAL_QUESTION))
                 .select(F.col("fieldId").alias("__q_field"), F.col("placeholder").alias("pergunta_cadastrada"),
                         F.col("placeholderParsed").alias("pergunta_tratada")))
    scope = scope or edition_scope(tables, edition)
    dim = scope.tickets
    # The edition's buyers in the date range, and the id set that filters the all-events answers in their scan.
    buyers = scope.buyers_between(first, last)
    ids = key_set(buyers, "__pid")
    paid, cancels = scope.sessions_of(buyers), scope.cancels_of(ids)
    answers = (restrict(tables["formfieldanswer"], "checkoutParticipantId", ids)
               .filter(~F.col("answer").isin(list(fv.REJECTED_ANSWERS)))
               .select(F.col("checkoutParticipantId").alias("participant_id"),
                       F.col("fieldId").alias("field_id"), F.col("answer").alias("cep")))
    complements = _of_edition(tables["eventticketcomplement"].select(F.col("ticketId").alias("__ticket")),
                              dim, "__ticket")

    def counted_buyers():
        counted = attach_copies(buyers.join(paid, "__session"), "__ticket", match_copies(complements, "__ticket"), "__races")
        counted = attach_copies(counted, "__pid", null_reason_copies(cancels), "__kept")
        return materialize(counted.filter(F.col("__kept") > 0), "paid-buyers")

    def postal_answers():
        # written once: the matching of the field ids and the join with the buyers read that copy
        return join_collated(materialize(answers, "answers"), "field_id", questions, "__q_field", collation).drop("__q_field")

    # The question matching and the buyers' row multiplicity are independent;
    # their small eager jobs run concurrently.
    answers, buyers = run_concurrently(dim.sparkSession, postal_answers, counted_buyers)
    forms = repeat_rows(answers.join(buyers, F.col("participant_id") == F.col("__pid")),
                        F.col("__races") * F.col("__kept")).select(
        "participant_id", "data_compra", F.col("__edition").alias("edicao"),
        F.col("__event_title").alias("evento"), "field_id", "pergunta_cadastrada",
        "pergunta_tratada", "cep")
    order = ["participant_id"] + [c for c in FORMS_COLUMNS if c not in ("batch_number", "participant_id")]
    numbered = number_batches(forms, order, rows_per_batch, max_rows, workdir=workdir)
    return numbered.select(*FORMS_COLUMNS)


def extract_participants(tables: dict[str, DataFrame], edition: str,
                         first=None, last=None,
                         max_rows: int | None = None,
                         rows_per_batch: int = fv.DEFAULT_ROWS_PER_BATCH,
                         as_of: dt.date | str | None = None,
                         excluded_events=(fv.SERVICE_SHOP_EVENT_ID,),
                         drop_unused_fanout: bool = False, workdir: str | None = None,
                         scope: EditionScope | None = None) -> DataFrame:
    """The 25-column participant report of paid, non-cancelled buyers of ``edition``.

    The purchase date is the *session's* ``createdAt`` (local time).  ``as_of``
    is the date ages are computed at (required: results must not depend on
    the clock).  Trades of any status multiply rows as the original unused
    join does, unless ``drop_unused_fanout``.
    """
    if as_of is None:
        raise ValueError("as_of is required")
    scope = scope or edition_scope(tables, edition)
    dim = _tickets(scope, excluded_events)
    # The edition's participants; their id sets filter every table that spans all events (sessions, payments, summaries,
    # cancellations, trades, option choices) in its scan, before any join, aggregate or explode.
    p = scope.people.withColumnRenamed("__pid", "item_id")
    if excluded_events:
        p = p.filter(~F.col("__event").isin(list(excluded_events)))
    ids, session_ids = scope.id_sets
    sessions = scope.sessions_between(first, last)
    payments = restrict(tables["checkoutpayment"], "sessionId", session_ids).select(
        F.col("sessionId").alias("__pay_session"), F.col("paymentOption").alias("__payment"))
    summary = restrict(tables["checkoutsummary"], "sessionId", session_ids).select(
        F.col("sessionId").alias("__sum_session"), F.col("ticketInsurance").alias("__insurance"))
    types = _of_edition(tables["eventticketbatchpricetype"].select(F.col("id").alias("__type"),
                                                                  F.col("name").alias("ticket_type")),
                        dim, "__type")
    races = _of_edition(tables["eventticketcomplement"].select(F.col("ticketId").alias("__ticket"),
                                                               F.col("nameParsed").alias("race")),
                        dim, "__ticket")

    def paid_purchases():
        block = materialize(attach_sides(sessions, "__session", [(payments, "__pay_session"), (summary, "__sum_session")]), "session-block")
        return (p.drop("createdAt").join(block, "__session").withColumn("order_id", F.col("__session"))
                 .join(broadcast_if_small(types), "__type", "left").join(broadcast_if_small(races), "__ticket", "left"))

    def choices():
        # Narrow rows, one or more per participant: chosen options, trade partners, number of repeats.
        def correlations():
            roles = trade_roles(tables["tradecheckoutsession"], ids)
            return roles, trade_sides(roles, tables["checkoutparticipant"])
        options, (roles, (as_old, as_new)) = run_concurrently(
            dim.sparkSession,
            lambda: option_answer_groups(
                _option_view(tables, ids), tables["eventticketstockitems"],
                tables["eventticketstockitemscomplement"], tables["eventticketstock"],
                {"shirts": (fv.SHIRT_STOCK_NAMES, {"nameParsed": "shirt"}),
                 "kits": (fv.KIT_PICKUP_STOCK_NAMES, {"day": "pickup_day", "hour": "pickup_hour"})},
                "__opt_pid"),
            correlations)
        rows = p.filter(F.col("item_id").isNotNull()).select(F.col("item_id").alias("__id")).distinct()
        unused = () if drop_unused_fanout else ((roles.filter(F.col("__rc_role") == OLD), "__rc_key"),)
        rows = attach_copies(rows, "__id", combined_copies(scope.cancels_of(ids), unused), "__copies").filter(F.col("__copies") > 0)
        return materialize(attach_sides(rows, "__id", [(options["shirts"], "__opt_pid"), (options["kits"], "__opt_pid"),
                                                       (as_old, "__rc_old_key"), (as_new, "__rc_new_key")]), "choices")

    p, rows = run_concurrently(dim.sparkSession, lambda: materialize(paid_purchases(), "purchases"), choices)
    # every kept id has its rows in the narrow table; a participant without an id can have no choices
    p = p.join(rows, F.col("item_id") == F.col("__id")).drop("__id").unionByName(
        p.filter(F.col("item_id").isNull()), allowMissingColumns=True)
    p = repeat_rows(correlated(p), F.coalesce("__copies", F.lit(1)))
    age = age_years("birth_date", as_of)
    report = p.select(
        "item_id", "order_id", "purchase_date", "participant", "correlated_item_id",
        "correlated_participant", F.col("__edition").alias("edition"),
        F.col("__event_title").alias("event"), "race", F.col("__ticket_name").alias("ticket"),
        "ticket_type", "ticket_tracking", "coupon", payment_label("__payment").alias("payment_method"),
        "email", "phone", "cpf", "birth_date", age.alias("age"), age_band(age).alias("age_band"),
        "shirt", refund_mark("__insurance").alias("refundable"), "pickup_day", "pickup_hour")
    order = ["item_id"] + [c for c in PARTICIPANT_COLUMNS if c not in ("batch_number", "item_id")]
    numbered = number_batches(report, order, rows_per_batch, max_rows, workdir=workdir)
    return numbered.select(*PARTICIPANT_COLUMNS)
