"""Address lookup as a data job over landed provider responses.

Responses are landed once per (provider, requested code) in the
``responses`` table (raw JSON text).  The original lookup asked each
provider row by row, falling back to the next one on failure; here the
same decisions are joins:

* each distinct code is decided once (identical codes are not re-asked); the
  codes in use are written once and, when their number is within the
  broadcast bound, broadcast so the responses landing (every code ever
  requested) is filtered in its scan instead of shuffled;
* a provider *accepts* a code in the fallback chain when its body is a JSON
  object holding the key ``cep`` (its value may be null);
* one aggregate per code keeps every provider's latest body (``max_by``,
  partially aggregated on the map side, so a code fetched many times is no
  hot spot); the winner is the first provider in the chain whose latest body
  accepts, and only its body is parsed;
* the per-code decisions are written and joined back to the form rows: a
  plain scan on both sides, so skew handling can split a hot code (such as the
  ``00000-000`` filler) on the row side, and AQE broadcasts small decisions;
* counters are sums over codes of their form rows, which were counted when the
  codes in use were, observed while the decisions are written; no row is joined
  and no job is run for them.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rollcall.fixed_values import ADDRESS_FIELDS, PROVIDER_URLS, PROVIDERS, URL_PLACEHOLDER
from rollcall.functions.responses import address_fields, has_key, is_object, provider_accepts
from rollcall.operators.sizing import broadcast_if_small
from rollcall.session import materialize, scratch_folder

PROVIDER_ORDER = tuple(name for name, _, _ in PROVIDERS)


class Resolved(NamedTuple):
    rows: DataFrame        # every form row with its winning provider rank (null if none)
    addresses: DataFrame   # item_id + the six address fields, resolved rows only
    counters: DataFrame    # one row: ok, nok, <provider>_errors
    unresolved: DataFrame  # form rows no provider accepted


def latest_responses(responses: DataFrame) -> DataFrame:
    """One body per (provider, code): the last fetched (ties broken by body text)."""
    return (responses.groupBy("provider", "cep_requested")
                     .agg(F.max_by("body", F.struct("fetched_at", "body")).alias("body")))


def latest_answers(responses: DataFrame) -> DataFrame:
    """The last fetched answer per (provider, code) as rows of the landing (ties broken by body text)."""
    last = F.max(F.struct("fetched_at", "body")).alias("last")
    return responses.groupBy("cep_requested", "provider").agg(last).select(
        "provider", "cep_requested", F.col("last.body").alias("body"), F.col("last.fetched_at").alias("fetched_at"))


def _bucketed(codes: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """``codes`` written in buckets like those of an answer table, and the table's name."""
    spark = codes.sparkSession
    name = f"rollcall_codes_{uuid.uuid4().hex}"
    (codes.repartition(buckets, "cep_requested").write.format("parquet").bucketBy(buckets, "cep_requested").sortBy("cep_requested")
          .option("path", f"{scratch_folder(spark)}/{name}").saveAsTable(name))
    return spark.table(name), name


def _codes_in_use(forms: DataFrame, code_col: str, counted: str | None = None) -> DataFrame:
    """Distinct codes of the form rows and their ``n_rows``, written once (a partial aggregate collapses hot codes).

    With ``counted``, only rows where that column is true are counted.
    """
    return materialize(_count_codes(forms, code_col, counted), "codes")


def _count_codes(forms: DataFrame, code_col: str, counted: str | None = None) -> DataFrame:
    n_rows = F.count("*") if counted is None else F.count_if(F.col(counted))
    return forms.groupBy(F.col(code_col).alias("cep_requested")).agg(n_rows.alias("n_rows"))


def _rows_where(condition) -> "F.Column":
    """Sum of ``n_rows`` over the codes that meet the condition."""
    return F.coalesce(F.sum(F.when(condition, F.col("n_rows"))), F.lit(0)).cast("long")


def _answered(responses: DataFrame, codes: DataFrame) -> DataFrame:
    """Responses for the codes in use only: a scan-side filter when the code set is broadcast."""
    return responses.join(broadcast_if_small(codes.select("cep_requested")), "cep_requested", "left_semi")


def parse_responses(responses: DataFrame, provider: str) -> DataFrame:
    """Per code of one provider: ``is_object``, ``accepted`` (its own rule), fields."""
    mine = latest_responses(responses.filter(F.col("provider") == F.lit(provider)))
    return mine.select(
        "cep_requested",
        is_object("body").alias("is_object"),
        provider_accepts("body", provider).alias("accepted"),
        address_fields("body").alias("fields"))


def lookup_provider(forms: DataFrame, responses: DataFrame, provider: str,
                    code_col: str = "parsed_ceps", id_col: str = "participant_id"):
    """Ask one provider for every form row.

    Returns ``(rows, counters)``.  ``rows`` holds every form row with
    ``status``: ``ok`` (accepted, fields filled), ``nok`` (an object the
    provider rejects) or ``error`` (no answer, or not a JSON object; the
    original job skipped or aborted on these and counted them nowhere).
    ``counters`` has ``ok``, ``nok`` and the extra ``errors``.
    """
    # written first, so that a hot code's rows can be split in the join
    codes = _codes_in_use(forms, code_col)
    parsed = materialize(parse_responses(_answered(responses, codes), provider), "parsed")
    joined = forms.join(parsed, F.col(code_col) == F.col("cep_requested"), "left")
    status = (F.when(F.col("accepted"), F.lit("ok"))
                .when(F.col("is_object"), F.lit("nok"))
                .otherwise(F.lit("error")))
    rows = joined.select(
        F.col(id_col).cast("string").alias("item_id"), F.col(code_col), status.alias("status"),
        *[F.when(F.col("accepted"), F.col(f"fields.{f}")).alias(f) for f in ADDRESS_FIELDS])
    decided = codes.join(parsed, "cep_requested", "left").withColumn("status", status)
    counters = decided.agg(*[_rows_where(F.col("status") == s).alias(c)
                             for s, c in (("ok", "ok"), ("nok", "nok"), ("error", "errors"))])
    return rows, counters


def _latest_bodies(responses: DataFrame, codes: DataFrame, providers) -> DataFrame:
    """Per answered code the latest body of every provider, ``__rc_b1``, ``__rc_b2``...; null where there is none.

    The ordering of a ``max_by`` is null on the other providers' rows, so they are skipped.
    """
    latest = []
    for i, name in enumerate(providers, start=1):
        mine = F.col("provider") == F.lit(name)
        latest.append(F.max_by(F.when(mine, F.col("body")), F.when(mine, F.struct("fetched_at", "body")))
                       .alias(f"__rc_b{i}"))
    return (_answered(responses.filter(F.col("provider").isin(list(providers))), codes)
            .groupBy("cep_requested").agg(*latest))


def provider_counters(forms: DataFrame, responses: DataFrame, providers=PROVIDER_ORDER,
                      code_col: str = "parsed_ceps") -> DataFrame:
    """``provider, ok, nok, errors`` over all form rows, as ``lookup_provider`` counts them, from one pass."""
    codes = _codes_in_use(forms, code_col)
    state = codes.join(_latest_bodies(responses, codes, providers), "cep_requested", "left")
    sums = []
    for i, name in enumerate(providers, start=1):
        accepted = F.coalesce(provider_accepts(f"__rc_b{i}", name), F.lit(False))
        found = is_object(f"__rc_b{i}")
        sums.append(F.struct(F.lit(name).alias("provider"), _rows_where(accepted).alias("ok"),
                             _rows_where(found & ~accepted).alias("nok"), _rows_where(~found).alias("errors")))
    return state.agg(F.array(*sums).alias("s")).select(F.inline("s"))


def code_winners(responses: DataFrame, codes: DataFrame, providers=PROVIDER_ORDER) -> DataFrame:
    """Per code: ``winner_rank`` (1-based, null if none accepts) and the winner's fields.

    One aggregate per code (``_latest_bodies``), then the first provider whose
    latest body accepts wins.  Only the winning body is parsed into fields.
    """
    per_code = _latest_bodies(responses, codes, providers)
    rank = F.when(has_key(F.col("__rc_b1")), F.lit(1))
    for i in range(2, len(providers) + 1):
        rank = rank.when(has_key(F.col(f"__rc_b{i}")), F.lit(i))
    bodies = F.array(*[F.col(f"__rc_b{i}") for i in range(1, len(providers) + 1)])
    decided = (per_code.withColumn("winner_rank", rank)       # each body parsed once, chain order
                       .select("cep_requested", "winner_rank",
                               F.element_at(bodies, F.col("winner_rank")).alias("__rc_body")))
    return codes.join(decided, "cep_requested", "left").select(
        "cep_requested", "n_rows", "winner_rank", address_fields(F.col("__rc_body")).alias("fields"))


def pending_requests(forms: DataFrame, responses: DataFrame, providers=PROVIDER_ORDER,
                     code_col: str = "parsed_ceps", urls: dict[str, str] = PROVIDER_URLS) -> DataFrame:
    """The next request of the fallback chain for every code in use: ``provider``, ``cep_requested``, ``url``.

    Walking the providers in order, a code needs the first provider that has
    no landed answer yet, as long as every earlier provider answered without
    accepting; a code some provider accepted, or that every provider
    answered, needs nothing.  An external fetcher lands the answers to these
    requests in ``responses`` and the next call yields the following step,
    so each code is asked once per provider and never past its first success.
    """
    codes = _codes_in_use(forms, code_col)
    answered = []
    for i, name in enumerate(providers, start=1):
        mine = F.col("provider") == F.lit(name)
        answered.append(F.max(F.when(mine, F.lit(True))).alias(f"__rc_a{i}"))
        answered.append(F.max_by(F.when(mine, F.col("body")), F.when(mine, F.struct("fetched_at", "body")))
                         .alias(f"__rc_b{i}"))
    state = (_answered(responses.filter(F.col("provider").isin(list(providers))), codes)
             .groupBy("cep_requested").agg(*answered))
    step = None
    for i in range(1, len(providers) + 1):
        missing, accepted = F.col(f"__rc_a{i}").isNull(), has_key(F.col(f"__rc_b{i}"))
        step = (F.when(missing, F.lit(i)) if step is None else step.when(missing, F.lit(i))).when(
            accepted, F.lit(None).cast("int"))
    names = F.element_at(F.array(*[F.lit(n) for n in providers]), F.col("__rc_step"))
    templates = F.element_at(F.array(*[F.lit(urls[n]) for n in providers]), F.col("__rc_step"))
    decided = codes.join(state, "cep_requested", "left")   # a code nobody answered: first provider
    return (decided.select("cep_requested", step.alias("__rc_step"))
                   .filter(F.col("__rc_step").isNotNull())
                   .select(names.alias("provider"), "cep_requested",
                           F.replace(templates, F.lit(URL_PLACEHOLDER), F.col("cep_requested")).alias("url")))


def resolve_addresses(forms: DataFrame, responses: DataFrame, providers=PROVIDER_ORDER,
                      code_col: str = "parsed_ceps", id_col: str = "participant_id",
                      materialized: bool = False, counted: str | None = None, buckets: int | None = None,
                      tag: str | None = None) -> Resolved:
    """First-success fallback over ``providers`` for every form row.

    The per-code decisions are written once, and the counters are observed
    during that write; with ``materialized`` the row-level result is written
    once as well, so that addresses and unresolved rows do not join twice.

    With ``counted`` (a boolean column of ``forms``), counters and unresolved
    rows are of the rows where it is true.  ``buckets`` says that ``responses``
    is a table of so many buckets by code (``streaming.latest``): the codes in
    use are written in buckets alike, and neither side is shuffled.  ``tag``
    names a column of ``forms`` that addresses keep and counters are grouped by.
    """
    spark = forms.sparkSession
    if buckets is None:
        codes, name = _codes_in_use(forms, code_col, counted), None
    else:
        codes, name = _bucketed(_count_codes(forms, code_col, counted), buckets)
    # written first: the row join then has plain shuffles on both sides, and a hot code's rows can be split
    winners, counters = _observed_winners(code_winners(responses, codes, providers), providers)
    if name is not None:
        spark.sql(f"DROP TABLE {name}")
    rows = forms.join(winners.drop("n_rows"), F.col(code_col) == F.col("cep_requested"), "left").drop("cep_requested")
    if materialized:
        rows = materialize(rows, "resolved")
    addresses = rows.filter(F.col("winner_rank").isNotNull()).select(
        F.col(id_col).cast("string").alias("item_id"), *([F.col(tag)] if tag else []),
        *[F.col(f"fields.{f}").alias(f) for f in ADDRESS_FIELDS])
    if tag is not None:
        mine = rows if counted is None else rows.filter(F.col(counted))
        counters = mine.groupBy(tag).agg(*[F.count_if(c).alias(n) for n, c in _outcomes(providers).items()])
    failed = rows.filter(F.col("winner_rank").isNull())
    unresolved = (failed if counted is None else failed.filter(F.col(counted)).drop(counted)).drop("winner_rank", "fields")
    return Resolved(rows.drop("fields"), addresses, counters, unresolved)


def _outcomes(providers) -> dict:
    """What the fallback counts, by the rank of a row's winner."""
    rank = F.coalesce(F.col("winner_rank"), F.lit(len(providers) + 1))
    return {"ok": F.col("winner_rank").isNotNull(), "nok": F.col("winner_rank").isNull(),
            **{f"{name}_errors": rank > F.lit(i) for i, name in enumerate(providers, start=1)}}


def _observed_winners(winners: DataFrame, providers) -> tuple[DataFrame, DataFrame]:
    """``winners`` written, and the fallback's counters as observed while they were."""
    sums = _outcomes(providers)
    seen = Observation()
    written = materialize(winners.observe(seen, *[_rows_where(c).alias(n) for n, c in sums.items()]), "code-winners")
    counters = winners.sparkSession.createDataFrame([tuple(seen.get[n] for n in sums)], ", ".join(f"{n} long" for n in sums))
    return written, counters
