"""Sinks: per-edition extracts, the timestamped report, labels and previews."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.fixed_values import PARTICIPANT_DISPLAY_NAMES, REPORT_STAMP
from rollcall.sources.commits import commit_part


def label_text(col) -> "F.Column":
    """Blanks to underscores, as in file labels."""
    col = F.col(col) if isinstance(col, str) else col
    return F.replace(col, F.lit(" "), F.lit("_"))


def edition_label(df: DataFrame, col: str = "edition") -> DataFrame:
    """One row, ``edition_label``: the smallest edition value, blanks as ``_``.

    ``min`` rather than "first seen" so the label does not depend on row order.
    """
    return df.agg(label_text(F.min(col)).alias("edition_label"))


def write_extract(df: DataFrame, path: str, edition_col: str, cluster_by: str = "batch_number",
                  edition: str | None = None) -> str:
    """Write an extract by its edition label.

    With ``edition``, ``df`` is what that edition now has, also when that is
    nothing: it replaces the edition's part of the extract (``commit_part``).
    Without, dynamic overwrite replaces the editions present in ``df``.  Either
    way other editions stay.  Rows are clustered by ``cluster_by`` inside
    each file, so reading one batch back (``batch_number = n``) skips the
    row groups of the others through their Parquet statistics.
    """
    clustered = [cluster_by] if cluster_by in df.columns else []
    if edition is not None:
        rows = df.sortWithinPartitions(*clustered) if clustered else df
        return commit_part(rows, path, {"edition_label": _label(edition)})
    labelled = df.withColumn("edition_label", label_text(edition_col))
    if clustered:
        labelled = labelled.sortWithinPartitions("edition_label", cluster_by)
    (labelled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("edition_label").parquet(path))
    return path


def display_participants(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Rename internal snake_case columns to the report's display names."""
    names = {**PARTICIPANT_DISPLAY_NAMES, **(extra or {})}
    return df.select([F.col(c).alias(names.get(c, c)) for c in df.columns])


def write_report(df: DataFrame, path: str, run_ts: dt.datetime, edition_col: str = "edition",
                 fmt: str = "parquet", edition: str | None = None, batch: int | None = None) -> str:
    """Write the report under ``report_label=<edition label>/run_ts=<YYYYMMDD_HHMM>``.

    With ``edition`` the report is one part, ``.../batch=<number, or all>``, which
    replaces exactly the same part of an earlier write: batches reported within
    one minute lie beside each other, and an empty report is a part without rows.
    Without, the label is computed per row (blanks as ``_``) and rows of several
    editions land in one folder each.  ``fmt="csv"`` writes CSV with a header
    line (for spreadsheet users) instead of Parquet.  Returns the base path.
    """
    if edition is not None:
        return write_beside_report(df, path, run_ts, edition, fmt, batch)
    stamp = run_ts.strftime(REPORT_STAMP)
    writer = (df.withColumn("report_label", F.coalesce(label_text(edition_col), F.lit("_")))
                .withColumn("run_ts", F.lit(stamp))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("report_label", "run_ts").format(fmt))
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
    return path


def write_beside_report(df: DataFrame, path: str, run_ts: dt.datetime, edition: str, fmt: str = "parquet",
                        batch: int | None = None) -> str:
    """Write what goes with one edition's report (counters, failed codes) under the same label, time and batch."""
    part = {"report_label": _label(edition), "run_ts": run_ts.strftime(REPORT_STAMP), "batch": "all" if batch is None else batch}
    return commit_part(df, path, part, fmt)


def _label(edition: str) -> str:
    return edition.replace(" ", "_")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
