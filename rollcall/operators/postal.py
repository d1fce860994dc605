"""Postal-code normalisation and its profile."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rollcall.fixed_values import POSTAL_DIGITS, PROFILE_LABELS
from rollcall.functions.postal import normalised, raw_text, stripped, underscore_count


def normalise_postal_codes(df: DataFrame, col: str = "cep", out: str = "parsed_ceps") -> DataFrame:
    """Add ``out`` (``NNNNN-NNN``) and an always-null ``peculiar_ceps``.

    One codegen projection.  Dots, blanks and letters are kept, as in the
    original cleaning; a missing answer becomes ``00000-000``.
    """
    return (df.withColumn(out, normalised(col))
              .withColumn("peculiar_ceps", F.lit(None).cast("string"))
              .filter(F.col("peculiar_ceps").isNull()))


def _profile_counters(col: str) -> list:
    length = F.length(stripped(col))
    return [
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(underscore_count(col)), F.lit(0)).cast("long").alias("with_underscore"),
        F.count_if(~raw_text(col).contains("-")).alias("without_hyphen"),
        F.count_if(length == POSTAL_DIGITS).alias("ok"),
        F.count_if(length < POSTAL_DIGITS).alias("too_short"),
        F.count_if(length > POSTAL_DIGITS).alias("too_long"),
        F.count_if(F.lit(False)).alias("peculiar"),
    ]


def profile_postal_codes(df: DataFrame, col: str = "cep") -> DataFrame:
    """One row per metric: ``metric``, ``label``, ``n`` and ``share`` of all rows.

    Counted on the raw answers in a single aggregate: rows, underscore
    characters (not rows holding one, so the share can pass 1), rows without a
    hyphen, and cleaned lengths equal to, below and above 8.  ``share`` is null
    on empty input.
    """
    return _profile_rows(df.agg(*_profile_counters(col)))


def observe_profile(df: DataFrame, col: str = "cep") -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``df``, and a function giving its ``profile_postal_codes`` once it has been written: counted during that write."""
    seen = Observation()

    def profile() -> DataFrame:
        counts = {f: int(seen.get[f]) for f in PROFILE_LABELS}
        return _profile_rows(df.sparkSession.createDataFrame([tuple(counts.values())], ", ".join(f"{f} long" for f in counts)))
    return df.observe(seen, *_profile_counters(col)), profile


def _profile_rows(counts: DataFrame) -> DataFrame:
    metrics = list(PROFILE_LABELS)
    long_form = counts.withColumn("__rc_total", F.col("total")).unpivot(["__rc_total"], metrics, "metric", "n")
    labels = F.create_map(*[F.lit(x) for kv in PROFILE_LABELS.items() for x in kv])
    return long_form.select(
        "metric", labels[F.col("metric")].alias("label"), F.col("n").cast("long").alias("n"),
        (F.col("n") / F.nullif(F.col("__rc_total"), F.lit(0))).cast("double").alias("share"))


def profile_display(profile: DataFrame) -> DataFrame:
    """Display form of the profile: ``label`` and ``qtde (percent)`` as ``"n (p.pp%)"``.

    Text for people only; the numbers stay in ``profile_postal_codes``.  A
    null share (empty input) leaves the text null.
    """
    text = F.when(F.col("share").isNotNull(),
                  F.format_string("%d (%.2f%%)", F.col("n"), F.col("share") * F.lit(100.0)))
    return profile.select("label", text.alias("qtde (percent)"))
