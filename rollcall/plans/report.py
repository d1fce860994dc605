"""The whole job: extractions, postal cleaning, address fallback, report join."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall import fixed_values as fv
from rollcall.operators.lookup import PROVIDER_ORDER, Resolved, resolve_addresses
from rollcall.operators.batching import select_batch
from rollcall.operators.postal import normalise_postal_codes
from rollcall.operators.report import join_addresses
from rollcall.plans.extract import edition_scope, extract_forms, extract_participants
from rollcall.session import materialize, run_concurrently


#: The batch that a form row is reported in, where several are reported at once.
BATCH = "report_batch"


class Report(NamedTuple):
    participants: DataFrame
    forms: DataFrame
    resolved: Resolved
    report: DataFrame


def extract_edition(tables: dict[str, DataFrame], edition: str, first, last, as_of,
                    rows_per_batch: int = fv.DEFAULT_ROWS_PER_BATCH, max_rows: int | None = None,
                    excluded_events=(fv.SERVICE_SHOP_EVENT_ID,), workdir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Participants, and forms with cleaned codes, of one edition.

    The two extractions are independent (an empty forms extract does not stop
    the participant one); their eager steps run concurrently.
    """
    scope = edition_scope(tables, edition, shared=True)
    people, answers = run_concurrently(
        scope.checkout.sparkSession,
        lambda: extract_participants(tables, edition, first, last, max_rows, rows_per_batch, as_of, excluded_events,
                                     workdir=workdir, scope=scope),
        lambda: extract_forms(tables, edition, first, last, max_rows, rows_per_batch, workdir=workdir, scope=scope))
    return people, normalise_postal_codes(answers)


def batch_forms(participants: DataFrame, forms: DataFrame, batch: int | range) -> DataFrame:
    """The form rows that one batch of participants needs, and ``__rc_owned``: whether the batch counts them.

    A batch needs the rows of its participants.  Each row is counted by one
    batch: that of its participant's first row, or batch 1 when the participant
    is in none (another purchase date, an excluded event).  So a participant
    whose rows straddle two batches is reported in both and counted once.

    For a range of batches, the rows of each of them with its number as ``report_batch``, from one join.
    """
    batches = batch if isinstance(batch, range) else range(batch, batch + 1)
    low, high = F.lit(batches.start).cast("long"), F.lit(batches.stop - 1).cast("long")
    first = materialize(participants.groupBy(F.col("item_id").alias("__rc_person"))
                        .agg(F.min("batch_number").alias("__rc_first"), F.max("batch_number").alias("__rc_last")), "batches-of-people")
    mine = forms.join(first.filter((F.col("__rc_first") <= high) & (F.col("__rc_last") >= low)),
                      F.col("participant_id") == F.col("__rc_person"))
    mine = mine.withColumn(BATCH, F.explode(F.sequence(F.greatest("__rc_first", low), F.least("__rc_last", high)))) \
        .withColumn("__rc_owned", F.col("__rc_first") == F.col(BATCH))
    mine = mine.select(*forms.columns, "__rc_owned", BATCH)
    if 1 in batches:
        nobody = forms.join(first, F.col("participant_id") == F.col("__rc_person"), "left_anti")
        mine = mine.unionByName(nobody.withColumn("__rc_owned", F.lit(True)).withColumn(BATCH, F.lit(1).cast("long")))
    return mine if isinstance(batch, range) else mine.drop(BATCH)


def report_from_extract(participants: DataFrame, forms: DataFrame, responses, batch: int | range | None = None,
                        providers=PROVIDER_ORDER, materialize_lookup: bool = True) -> Report:
    """The report of an extract, or of one batch of its participants and their form rows.

    Reports, counters and unresolved rows of all batches add up to those of the whole extract (``batch_forms``).
    A range of batches is reported in as many jobs as one: every batch from its own form rows, with counters (where
    it counts any) and unresolved rows by ``report_batch``.
    """
    counted = tag = None
    if batch is not None:
        forms, counted = batch_forms(participants, forms, batch), "__rc_owned"
    if isinstance(batch, range):
        tag = BATCH
        participants = participants.filter(F.col("batch_number").between(batch.start, batch.stop - 1))
    elif batch is not None:
        participants = select_batch(participants, batch)
    resolved = resolve_addresses(forms, responses, providers, materialized=materialize_lookup, counted=counted, tag=tag)
    report = join_addresses(participants, resolved.addresses, same=None if tag is None else ("batch_number", tag))
    return Report(participants, forms, resolved, report)


def build_report(tables: dict[str, DataFrame], responses, edition: str, first, last, as_of,
                 rows_per_batch: int = fv.DEFAULT_ROWS_PER_BATCH, max_rows: int | None = None,
                 excluded_events=(fv.SERVICE_SHOP_EVENT_ID,), providers=PROVIDER_ORDER,
                 workdir: str | None = None, materialize_lookup: bool = True) -> Report:
    """Participants of ``edition`` with the address of every postal code they answered.

    ``responses`` is the landed responses table, or a callable that builds it
    from the cleaned forms (for landings keyed by the codes in use).  The lookup
    rows are written once to the shared checkpoint folder
    (``materialize_lookup``) for the report and the addresses.
    """
    participants, forms = extract_edition(tables, edition, first, last, as_of, rows_per_batch, max_rows,
                                          excluded_events, workdir)
    landed = responses(forms) if callable(responses) else responses
    return report_from_extract(participants, forms, landed, None, providers, materialize_lookup)
